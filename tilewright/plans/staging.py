"""The main pipeline: features to rows of tiles, what to do with tiles that exist, summaries, and archives."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, fields, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..functions import crs as crs_
from ..functions import polygons as polygons_
from ..functions.box import Box
from ..functions.paths import TilePaths, tile_text
from ..operators import dedup as dedup_
from ..operators.grid import TILE_MATRIX_SETS, Grid, reprojected, tile_bounds, tms_grids
from ..runtime import cut

#: Names of the added columns; fixed values.
PROPS = {
    "tile": "staging_tile", "centroid_tile": "staging_centroid_tile", "area": "staging_area", "centroid_x": "staging_centroid_x", "centroid_y": "staging_centroid_y",
    "filename": "staging_filename", "identifier": "staging_identifier", "centroid_within_tile": "staging_centroid_within_tile", "duplicated": "staging_duplicated",
}


@dataclass(frozen=True)
class StagingConfig:
    tms_id: str = "WGS1984Quad"
    z: int = 13
    input_crs: int | str | None = None
    simplify_tolerance: float | None = None
    clip_to_footprint: bool = False
    dedup_method: str | None = None
    deduplicate_at: str = "staging"
    split_by: str = "staging_filename"
    keep_rules: tuple[tuple[str, str], ...] = ()
    overlap_tolerance: float | None = 0.5
    overlap_both: bool = True
    centroid_tolerance: float | None = None
    distance_crs: int | str | None = 3857
    props: dict[str, str] = field(default_factory=lambda: dict(PROPS))

    def __post_init__(self) -> None:
        TilePaths(self.tms_id)
        if self.dedup_method not in (None, "neighbor", "neighbors", "footprints", "footprint"):
            raise ValueError(f"unknown deduplication method: {self.dedup_method}")
        object.__setattr__(self, "props", PROPS | self.props)
        object.__setattr__(self, "keep_rules", tuple(map(tuple, self.keep_rules)))

    @staticmethod
    def load(source: str | dict) -> StagingConfig:
        """From a dict, or a JSON file on the driver; unknown names raise ``ValueError``."""
        if isinstance(source, str):
            with open(source, encoding="utf-8") as f:
                source = json.load(f)
        if unknown := set(source) - {f.name for f in fields(StagingConfig)}:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(StagingConfig(), **source)


def check_names(df: DataFrame, config: StagingConfig) -> None:
    """Raises ``ValueError`` where a column that staging adds, or an entry of a map ``attributes`` of that name, is there already, in whatever case."""
    added = {n.lower(): n for k, n in config.props.items() if k != "duplicated"}
    there = {c.lower() for c in df.columns}
    if "attributes" in df.columns and isinstance(df.schema["attributes"].dataType, MapType):
        name = F.lower(F.col("name"))
        found = df.select(F.explode(F.map_keys("attributes")).alias("name")).where(name.isin(*added)).select(name.alias("name")).distinct()
        there |= {r.name for r in found.collect()}  # of the few names that staging adds
    if taken := [n for low, n in added.items() if low in there]:
        raise ValueError(f"columns are there already: {taken}")


def only_polygons(features: DataFrame, kind: str = "geom_type") -> DataFrame:
    return features.where(F.col(kind).isin("Polygon", "MultiPolygon"))


def to_tms_crs(features: DataFrame, source: int | str | None, config: StagingConfig) -> DataFrame:
    """Features in the CRS of the tile matrix set: polygons by their vertices, boxes by their corners."""
    if config.input_crs is None and source is None:
        raise ValueError("the features' CRS isn't known; set input_crs")
    return reprojected(features, config.input_crs or source, TILE_MATRIX_SETS[config.tms_id]["crs"])


def simplify(features: DataFrame, tolerance: float | None) -> DataFrame:
    """Polygons without the vertices that lie within ``tolerance``; boxes, and None, leave the features as they are."""
    if tolerance is None or not polygons_.is_polygons(features):
        return features
    out = features.withColumn(polygons_.COLUMN, polygons_.simplified(F.col(polygons_.COLUMN), tolerance))
    return out.withColumns(polygons_.bounds(F.col(polygons_.COLUMN)))


def total_bounds(features: DataFrame) -> DataFrame:
    return features.agg(F.min("x0").alias("minx"), F.min("y0").alias("miny"), F.max("x1").alias("maxx"), F.max("y1").alias("maxy"))


def make_grids(features: DataFrame, config: StagingConfig) -> list[Grid]:
    """The tiles around the features: one small aggregation."""
    b = total_bounds(features).first()
    return tms_grids(config.tms_id, config.z, None if b.minx is None else (b.minx, b.miny, b.maxx, b.maxy))


def assign_tiles(features: DataFrame, grid: Grid, z: int, tile: str = "tile") -> DataFrame:
    """Each feature once for each tile that it meets (closed), with columns tile_x, tile_y, tile_z and the tile's text."""
    out = grid.meeting(features)
    row, col = grid._named(F.col("kx"), F.col("ky"))
    out = out.withColumns({"tile_x": col, "tile_y": row, "tile_z": F.lit(z)}).drop("kx", "ky")
    return out.withColumn(tile, tile_text(F.col("tile_x"), F.col("tile_y"), F.col("tile_z")))


def add_properties(features: DataFrame, grid: Grid, config: StagingConfig, filename: Column, identifier: Column | None = None) -> DataFrame:
    """Area, centroid, file name, identifier, centroid tile and tiles. The identifier is made before tiles are
    assigned, so that all copies of a feature share it: a hash of its file and of all its columns unless given.
    With the columns layer and fid of the vector sources among them, equal features of a file have different ones."""
    check_names(features, config)
    p, (x, y), area = config.props, Box().centroid, Box().area
    made = F.sha2(F.to_json(F.struct(filename.alias("f"), *features.columns)), 256) if identifier is None else identifier
    out = features.withColumns({p["filename"]: filename, p["identifier"]: made})
    if polygons_.is_polygons(features):
        out, (area, x, y) = out.withColumn("m_", polygons_.measures(F.col(polygons_.COLUMN))), (F.col(f"m_.{c}") for c in ("area", "x", "y"))
    out = out.withColumns({p["area"]: area, p["centroid_x"]: x, p["centroid_y"]: y}).drop("m_")
    row, col = grid.indices_from_xy(F.col(p["centroid_x"]), F.col(p["centroid_y"]))
    out = out.withColumn(p["centroid_tile"], tile_text(col, row, F.lit(config.z)))
    out = assign_tiles(out, grid, config.z, p["tile"])
    return out.withColumn(p["centroid_within_tile"], F.coalesce(F.col(p["tile"]) == F.col(p["centroid_tile"]), F.lit(False)))


def filename_of(path: Column, directory: str) -> Column:
    """A path less the directory before it and slashes around it."""
    rest = F.when(path.startswith(directory), F.substring(path, F.lit(len(directory) + 1), F.length(path))).otherwise(path)
    return F.regexp_replace(rest, "^/+|/+$", "")


def stage(features: DataFrame, config: StagingConfig, filename: Column, crs: int | str | None = 4326, footprint: DataFrame | None = None, identifier: Column | None = None) -> DataFrame:
    """The whole pipeline up to writing: type filter, simplification, clip to the footprint, CRS, properties and tiles.

    Features are boxes or, with a column ``polygons``, polygons; a column geom_type, where there is one, filters
    polygons. ``footprint``: shapes in the features' CRS ``crs``; asking for a clip without one raises ``ValueError``.
    """
    out = only_polygons(features) if "geom_type" in features.columns else features
    if polygons_.is_polygons(features):
        out = out.where(~polygons_.is_empty(F.col(polygons_.COLUMN)))
    out = simplify(out, config.simplify_tolerance)
    if config.clip_to_footprint and config.dedup_method:
        if footprint is None:
            raise ValueError("clip_to_footprint needs a footprint")
        out = dedup_.clip_to_boundary(out.withColumn("clip_id_", F.monotonically_increasing_id()), footprint, "intersects", config.props["duplicated"], "clip_id_").drop("clip_id_")
    out = to_tms_crs(out, crs, config)
    staged = [add_properties(out, g, config, filename, identifier) for g in make_grids(out, config)]
    return staged[0] if len(staged) == 1 else staged[0].unionByName(staged[1])


def dedup_method(config: StagingConfig, footprints: DataFrame | None = None, key: str = "staging_identifier") -> Callable[[DataFrame], DataFrame] | None:
    """What the settings say, as a function of rows of tiles: each tile is deduplicated by itself."""
    label = config.props["duplicated"]
    if config.dedup_method is None:
        return None
    if config.dedup_method.startswith("neighbor"):
        crs = TILE_MATRIX_SETS[config.tms_id]["crs"]
        return lambda df: dedup_.deduplicate_neighbors(
            df, config.split_by, config.keep_rules, config.overlap_tolerance, config.overlap_both, config.centroid_tolerance, config.distance_crs, crs, label, key, [config.props["tile"]]
        )
    if footprints is None:
        raise ValueError("deduplication by footprints needs them")
    return lambda df: dedup_.deduplicate_by_footprint(df.withColumn(label, dedup_.normal(F.col(label)) if label in df.columns else F.lit(False)), footprints, config.split_by, config.keep_rules, label, key)


def save_plan(staged: DataFrame, existing: DataFrame | None, dedup: Callable[[DataFrame], DataFrame] | None, deduplicate_at: str = "staging", label: str = PROPS["duplicated"], tile: str = PROPS["tile"]) -> DataFrame:
    """The rows to write and how (``mode``), tile by tile.

    A tile that exists: with ``dedup``, old and new rows are deduplicated together and replace it
    ("overwrite"); without, new rows are added ("append"). A new tile: with ``dedup`` at "staging" rows that
    are labelled already are dropped, later they are kept, and a missing label is false; without, as is.
    """
    if existing is None:
        fresh, known, old = staged, None, None
    else:
        there = existing.select(tile).distinct()
        fresh, known = staged.join(there, tile, "left_anti"), staged.join(there, tile, "left_semi")
        old = existing.join(staged.select(tile).distinct(), tile, "left_semi")
    if dedup is not None:
        fresh = fresh.withColumn(label, dedup_.normal(F.col(label)) if label in fresh.columns else F.lit(False))
        if deduplicate_at == "staging":
            fresh = fresh.where(~F.col(label))
    out = fresh.withColumn("mode", F.lit("new"))
    if known is None:
        return out
    if dedup is None:
        return out.unionByName(known.withColumn("mode", F.lit("append")), allowMissingColumns=True)
    both = dedup_.combine_and_deduplicate(old, known, dedup, deduplicate_at, label)
    return out.unionByName(both.withColumn("mode", F.lit("overwrite")), allowMissingColumns=True)


def summarise(staged: DataFrame, config: StagingConfig, count: Column | None = None) -> DataFrame:
    """A row for each file and tile: how many polygons, their area, and the tile's bounds. Null keys are left out."""
    p = config.props
    rows = staged.where(F.col(p["filename"]).isNotNull() & F.col(p["tile"]).isNotNull())
    out = rows.groupBy(F.col(p["filename"]).alias("filename"), "tile_x", "tile_y", "tile_z").agg(F.count(F.lit(1) if count is None else count).alias("num_polygons"), F.sum(p["area"]).alias("area_polygons"))
    sides = tile_bounds(config.tms_id, F.col("tile_x"), F.col("tile_y"), F.col("tile_z"))
    return out.select("filename", "num_polygons", "area_polygons", "tile_x", "tile_y", "tile_z", *[sides[s].alias(f"tile_{s}") for s in ("top", "right", "bottom", "left")], F.lit(config.tms_id).alias("tms_identifier"))


#: The column that tells which batch wrote a row.
BATCH = "staging_batch"


def save_tiles(staged: DataFrame, path: str, config: StagingConfig, footprints: DataFrame | None = None, batch_id: str | None = None) -> DataFrame:
    """Writes rows of tiles under ``path``/tiles (by tms, z, x, y) and the batch's summary under ``path``/summary; returns the summary.

    Each tile is one partition and one task writes it. Replaced tiles go by dynamic partition overwrite.
    A batch can be written again after a crash: rows that an earlier attempt of the same ``batch_id`` has left are
    taken out first, and their tiles are replaced rather than added to. The summary is written last, and tells that
    the batch is done; a batch that it holds already isn't written again.
    """
    spark = staged.sparkSession
    batch = batch_id or uuid.uuid4().hex
    tiles, key = f"{path}/tiles", config.props["tile"]
    done = read_if_there(spark, f"{path}/summary")
    if done is not None:
        done = done.where(F.col("batch_id") == batch)
        if not done.isEmpty():
            return done
    keyed = lambda df: df.withColumns({"tms": F.lit(config.tms_id), "z": F.col("tile_z"), "x": F.col("tile_x"), "y": F.col("tile_y")})
    existing, torn = read_if_there(spark, tiles), None
    if existing is not None:
        existing = existing.drop("tms", "z", "x", "y")
        own = F.coalesce(F.col(BATCH) == batch, F.lit(False))
        torn, existing = cut(existing.where(own).select(key).distinct()), existing.where(~own)
    plan = save_plan(staged.withColumn(BATCH, F.lit(batch)), existing, dedup_method(config, footprints), config.deduplicate_at, config.props["duplicated"], key)
    if torn is not None and not torn.isEmpty():
        plan = plan.join(torn.withColumn("torn", F.lit(True)), key, "left")
        back = existing.join(plan.where("torn and mode <> 'overwrite'").select(key).distinct(), key, "left_semi").withColumn("mode", F.lit("overwrite"))
        plan = plan.withColumn("mode", F.when(F.col("torn"), "overwrite").otherwise(F.col("mode"))).drop("torn").unionByName(back, allowMissingColumns=True)
    plan = cut(plan)
    for rows, mode in ((plan.where("mode = 'overwrite'"), "overwrite"), (plan.where("mode <> 'overwrite'"), "append")):
        if not rows.isEmpty():
            out = keyed(rows.drop("mode")).repartition("tms", "z", "x", "y").write.partitionBy("tms", "z", "x", "y")
            out.option("partitionOverwriteMode", "dynamic").mode(mode).parquet(tiles)
    summary = cut(summarise(plan, config).withColumns({"datetime": F.current_timestamp(), "batch_id": F.lit(batch)}))
    summary.write.mode("append").parquet(f"{path}/summary")
    return summary


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, with the columns of all of its files; None where there isn't one."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def csv_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    """A CSV with a header as snappy Parquet; the CSV stays."""
    spark.read.csv(source, header=True, inferSchema=True).write.mode("overwrite").option("compression", "snappy").parquet(target)


def equal_to(rows: DataFrame, wanted: dict) -> DataFrame:
    """Rows in which every named column has the wanted value; null equals nothing."""
    for name, value in wanted.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows


def without(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    if missing := [c for c in columns if c not in rows.columns]:
        raise KeyError(missing)
    return rows.drop(*columns)


def write_archive(spark: SparkSession, path: str, config: StagingConfig | None = None) -> None:
    """The tiles under ``path``/tiles as an archive under ``path``/archive, in the same layout."""
    rows = archive(spark.read.option("mergeSchema", "true").parquet(f"{path}/tiles"), config)
    rows.repartition("tms", "z", "x", "y").write.mode("overwrite").partitionBy("tms", "z", "x", "y").parquet(f"{path}/archive")


def archive(staged: DataFrame, config: StagingConfig | None = None) -> DataFrame:
    """The rows that stand for their features, each in the tile of its centroid, less the columns that tell so."""
    p = (config or StagingConfig()).props
    return without(equal_to(staged, {p["centroid_within_tile"]: True}), [p["centroid_within_tile"], p["tile"]])
