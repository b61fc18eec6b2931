"""Summaries by hexagon of many input files in one job, with a log of what each file gave."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import polygons as polygons_
from ..operators import cells
from ..operators.dedup import normal
from ..operators.grid import reprojected
from ..runtime import cut

LOG = "input_path string, output_path string, h3_res int, ok boolean, seconds double, error string, datetime string"


def output_path(path: Column, root: str, out_dir: str, resolution: int, ext: str = ".gpkg") -> Column:
    """<parent of root>/<out_dir>/<path below root>/<stem>_h3r<resolution><ext>; the bare name where the path isn't below root."""
    root = root.rstrip("/")
    above = root.rsplit("/", 1)[0] if "/" in root else ""
    below = F.when(path.startswith(root + "/"), F.substring(path, F.lit(len(root) + 2), F.length(path))).otherwise(F.substring_index(path, "/", -1))
    return F.concat(F.lit(f"{above}/{out_dir}/".lstrip("/") if not root.startswith("/") else f"{above}/{out_dir}/"), F.regexp_replace(below, r"\.[^./]*$", ""), F.lit(f"_h3r{resolution}{ext}"))


def stage_all(
    features: DataFrame, resolution: int, sums: Sequence[str] = (), means: Sequence[str] = (), crs: int | str | None = 4326, area_crs: int | str = 6933, land: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``features``: boxes or polygons with input_path and, where reading failed, error. Returns the summary by file and cell, and the run log less its paths.

    Features, and ``land`` in the same CRS, go to the equal-area plane first; with land, cells get the land metrics.
    The summary holds each cell as ``polygons`` of that plane. Files that failed or hold nothing are logged as such
    and don't stop the others. All files are one job, so that no file has a time of its own: ``seconds`` is null.
    """
    if crs is None:
        raise ValueError("the features' CRS is needed")
    hexagon = cells.PlanarHex.of_resolution(resolution)
    sound = reprojected(features.where("x0 is not null"), crs, area_crs)
    exploded = hexagon.cells_of_box(sound)
    shape = F.col(polygons_.COLUMN) if polygons_.is_polygons(sound) else cells.Box()
    exploded = exploded.withColumn("part_", hexagon.shared_area(F.col("q"), F.col("r"), shape) / 1e6)
    key = ["input_path", "q", "r"]
    summary = cells.summarise(exploded, key, sums, means, "part_")
    if land is not None:
        shape = F.col(f"b.{polygons_.COLUMN}") if polygons_.is_polygons(land) else cells.Box("b.")
        shared = hexagon.shared_area(F.col("a.q"), F.col("a.r"), shape) / 1e6
        summary = cells.land_metrics(hexagon.as_box(cut(summary)), reprojected(land, crs, area_crs), key, F.lit(hexagon.area / 1e6), "area_km2", shared).drop("x0", "y0", "x1", "y1")
    summary = summary.withColumn(polygons_.COLUMN, hexagon.polygon(F.col("q"), F.col("r")))
    error = F.max("error") if "error" in features.columns else F.lit(None).cast("string")
    log = features.groupBy("input_path").agg(F.count("x0").alias("n"), error.alias("error"))
    log = log.withColumn("error", F.coalesce("error", F.when(F.col("n") == 0, "no features")))
    seconds = F.lit(None).cast("double").alias("seconds")
    return summary, log.select("input_path", F.lit(resolution).alias("h3_res"), normal(F.col("error").isNull()).alias("ok"), seconds, "error", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"))
