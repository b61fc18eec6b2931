"""python -m tilewright --config FILE --input DIR --output DIR [--footprints DIR] [--hex-res N --sum-cols A B --mean-cols C --land-polygons DIR]"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.polygons import to_wkb
from .operators.cells import valid_resolution
from .operators.grid import TILE_MATRIX_SETS, reprojected
from .plans import hex_runs, staging
from .runtime import cut
from .sources import vector


def build_parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tilewright", description="Stage vector files into tiles, and summarise them by hexagon.")
    out.add_argument("-c", "--config", help="JSON file of settings")
    out.add_argument("--input", required=True, help="folder of .shp or .gpkg files")
    out.add_argument("--output", required=True, help="folder for tiles, summary and hexagons")
    out.add_argument("--format", choices=("shp", "gpkg"), default="shp")
    out.add_argument("--srid", type=int, help="EPSG code of the inputs; default: what the files say, else 4326")
    out.add_argument("--footprints", help="folder of footprints in the same format and CRS, one file for each input of the same name")
    out.add_argument("--gpkg", action="store_true", help="write a GeoPackage for each tile and for the hexagons, too")
    out.add_argument("--hex-res", type=valid_resolution)
    out.add_argument("--sum-cols", nargs="*", default=[])
    out.add_argument("--mean-cols", nargs="*", default=[])
    out.add_argument("--land-polygons", help="folder of land polygons in the same format and CRS")
    out.add_argument("--area-epsg", type=int, default=6933, help="equal-area CRS of the hexagons")
    return out


def srid_of(found: DataFrame, given: int | None) -> int:
    """The CRS of all features; ``ValueError`` where files differ."""
    if given is not None:
        return given
    known = [r.srid for r in found.where("srid is not null").select("srid").distinct().limit(2).collect()]
    if len(known) > 1:
        raise ValueError("the inputs have different CRSs; stage them one CRS at a time")
    return known[0] if known else 4326


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("tilewright").getOrCreate()
    config = staging.StagingConfig.load(args.config) if args.config else staging.StagingConfig()
    read = vector.read_shp if args.format == "shp" else vector.read_gpkg
    found = cut(read(spark, args.input))
    srid = srid_of(found, args.srid or config.input_crs)
    polygons = vector.as_polygons(found)
    name = F.substring_index("input_path", "/", -1)
    shapes = polygons.select("input_path", "layer", "fid", "geom_type", "x0", "y0", "x1", "y1", "polygons", "attributes")
    boundary = zones = None
    if args.footprints:
        prints = vector.as_polygons(read(spark, args.footprints)).select(F.substring_index("input_path", "/", -1).alias(config.split_by), F.col("attributes").alias("attributes"), "x0", "y0", "x1", "y1", "polygons")
        prints = prints.select(config.split_by, "x0", "y0", "x1", "y1", "polygons", *[F.col("attributes")[r].alias(r) for r, _ in config.keep_rules])
        boundary = prints
        zones = reprojected(prints, srid, TILE_MATRIX_SETS[config.tms_id]["crs"])
    staged = staging.stage(shapes, config, name, srid, boundary)
    staging.save_tiles(staged, args.output, config, zones)
    if args.gpkg:
        tiles = spark.read.option("mergeSchema", "true").parquet(f"{args.output}/tiles").withColumn("geometry", to_wkb(F.col("polygons")))
        crs = TILE_MATRIX_SETS[config.tms_id]["crs"]
        vector.write_gpkg(tiles.select(config.props["tile"], "geometry", *[config.props[c] for c in ("area", "filename", "identifier")]), f"{args.output}/gpkg", config.props["tile"], srid=crs).write.mode("overwrite").parquet(f"{args.output}/gpkg_files")
    if args.hex_res:
        values = shapes.select("*", *[F.col("attributes")[c].cast("double").alias(c) for c in sorted({*args.sum_cols, *args.mean_cols})])
        failed = found.where("error is not null").select("input_path", "error")
        land = vector.as_polygons(read(spark, args.land_polygons)) if args.land_polygons else None
        summary, log = hex_runs.stage_all(values.unionByName(failed, allowMissingColumns=True), args.hex_res, args.sum_cols, args.mean_cols, srid, args.area_epsg, land)
        summary = cut(summary)
        summary.write.mode("overwrite").partitionBy("input_path").parquet(f"{args.output}/hexagons")
        log.write.mode("append").parquet(f"{args.output}/hex_log")
        if args.gpkg:
            cells = summary.withColumn("geometry", to_wkb(F.col("polygons"))).drop("polygons")
            vector.write_gpkg(cells, f"{args.output}/hex_gpkg", "input_path", srid=args.area_epsg).write.mode("overwrite").parquet(f"{args.output}/hex_gpkg_files")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
