"""Preparation of inputs: which footprint belongs to which file, and which path is preferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """A path's last part up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def date_of_id(identifier: Column) -> Column:
    """The second part of an id between underscores."""
    return F.get(F.split(identifier, "_"), 1)


def id_of_path(path: Column) -> Column:
    """A base name less its last two parts between underscores."""
    parts = F.split(base_name(path), "_")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 2, F.lit(0))), "_")


def subdir_of_footprint(path: Column, prefix: str, suffix: str) -> Column:
    """A footprint's base name less ``prefix``, with ``suffix``."""
    name = base_name(path)
    return F.concat(F.when(name.startswith(prefix), F.substring(name, F.lit(len(prefix) + 1), F.length(name))).otherwise(name), F.lit(suffix))


def footprint_path(path: Column, input_dir: str, footprint_dir: str, prefix: str = "", ext: str = ".shp") -> Column:
    """Where the footprint of an input file is: the same place below ``footprint_dir``, its name with ``prefix`` and ``ext``."""
    below = F.when(path.startswith(input_dir), F.substring(path, F.lit(len(input_dir) + 1), F.length(path))).otherwise(path)
    folder = F.regexp_replace(below, "[^/]*$", "")
    return F.concat(F.lit(footprint_dir.rstrip("/")), F.when(folder.startswith("/"), folder).otherwise(F.concat(F.lit("/"), folder)), F.lit(prefix), base_name(below), F.lit(ext))


def dir_to_filename(path: Column, prefix: str = "", suffix: str = "", ext: str = ".shp") -> Column:
    """A folder's last part less ``suffix``, with ``prefix`` and ``ext``: the name of its footprint."""
    name = F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)
    return F.concat(F.lit(prefix), F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name) if suffix else name, F.lit(ext))


def id_to_name(identifier: Column, suffix: str = "") -> Column:
    """A footprint's id as the name of its file: with ``suffix`` unless it ends so."""
    return F.when(identifier.endswith(suffix), identifier).otherwise(F.concat(identifier, F.lit(suffix))) if suffix else identifier


def status_counts(records: DataFrame, column: str = "status") -> DataFrame:
    """(status, n)."""
    return records.groupBy(column).agg(F.count("*").alias("n"))


def replacement_report(replaced: DataFrame, preferred: DataFrame) -> DataFrame:
    """Of ``preferred_paths``: how many paths there are, how many were replaced, how many preferred ones there are, and how many of these replaced none."""
    got = replaced.agg(F.count("*").alias("n_main"), F.sum(F.col("replaced").cast("long")).alias("n_replaced"))
    unused = preferred.join(replaced.where("replaced").select("path"), "path", "left_anti").agg(F.count("*").alias("n_unused"))
    return got.join(preferred.agg(F.count("*").alias("n_preferred"))).join(unused)


def directory_match(footprints: DataFrame, subdirs: DataFrame) -> DataFrame:
    """(original_footprint_path, key) against (key, path): status no_match, matched or multiple_matches, and the match if there is one."""
    n, match = F.count("path"), F.min("path")
    out = footprints.join(subdirs, "key", "left").groupBy("original_footprint_path").agg(n.alias("n"), match.alias("match"))
    status = F.when(F.col("n") == 0, "no_match").when(F.col("n") == 1, "matched").otherwise("multiple_matches")
    return out.select("original_footprint_path", status.alias("status"), F.when(F.col("n") == 1, F.col("match")).alias("match"))


def feature_match(features: DataFrame, files: DataFrame) -> DataFrame:
    """(original_footprint_path, footprint_id) against (path): the first file by path whose id is the feature's."""
    first = files.select(id_of_path(F.col("path")).alias("footprint_id"), "path").groupBy("footprint_id").agg(F.min("path").alias("match"))
    out = features.join(first, "footprint_id", "left")
    status = F.when(F.col("match").isNull(), "no_match").otherwise("matched")
    return out.select("original_footprint_path", "footprint_id", date_of_id(F.col("footprint_id")).alias("date"), status.alias("status"), "match")


def missing_footprints(paths: DataFrame, footprints: DataFrame) -> DataFrame:
    """Input paths (region, footprint_id, path) that no footprint (region, name) answers to."""
    known = footprints.select("region", F.col("name").alias("footprint_id")).distinct()
    return paths.join(known, ["region", "footprint_id"], "left_anti")


def preferred_paths(main: DataFrame, preferred: DataFrame) -> DataFrame:
    """Main paths, with the first (by path) of each base name replaced by the first preferred path of that name."""
    name = lambda: F.substring_index(F.col("path"), "/", -1).alias("name")
    best = preferred.select(name(), "path").groupBy("name").agg(F.min("path").alias("better"))
    rows = main.select("path", name())
    first = rows.groupBy("name").agg(F.min("path").alias("first"))
    out = rows.join(best, "name", "left").join(first, "name")
    swap = F.col("better").isNotNull() & (F.col("path") == F.col("first"))
    return out.select(F.col("path").alias("main_path"), F.when(swap, F.col("better")).otherwise(F.col("path")).alias("path"), swap.alias("replaced"))


def write_by_status(records: DataFrame, out_dir: str, statuses: tuple[str, ...] = ("no_match", "matched", "multiple_matches")) -> None:
    """Records as JSON lines, a folder for each status."""
    for status in statuses:
        records.where(F.col("status") == status).write.mode("overwrite").json(f"{out_dir}/{status}")


def write_lists(paths: DataFrame, missing: DataFrame, out_dir: str) -> None:
    """The final list of paths and that of inputs without a footprint, as JSON lines."""
    paths.write.mode("overwrite").json(f"{out_dir}/paths")
    missing.write.mode("overwrite").json(f"{out_dir}/missing")


def split_by_name(features: DataFrame, out_dir: str, name: str = "Name") -> None:
    """A folder for each feature name."""
    features.where(F.col(name).isNotNull()).withColumn("name_", F.col(name)).repartition("name_").write.mode("overwrite").partitionBy("name_").parquet(out_dir)


def in_first_order(df: DataFrame, by: str, order: str) -> DataFrame:
    """The first row of each ``by`` in ``order``."""
    return df.withColumn("n_", F.row_number().over(Window.partitionBy(by).orderBy(order))).where("n_ = 1").drop("n_")
