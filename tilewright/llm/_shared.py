"""Where intermediate results live: only in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a batch that goes to Python, where the session doesn't say otherwise: rows of long texts come in small batches.
BATCH_BYTES = "16m"


def bound_batches(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset and Spark runs in this process, as in tests, a folder of this machine."""
    sc = spark.sparkContext
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if set_dir is None:
        set_dir = sc._jsc.sc().getCheckpointDir().getOrElse(None) if sc._jsc.sc().getCheckpointDir().isDefined() else None
    if set_dir is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        set_dir = "file://" + tempfile.mkdtemp(prefix="tilewright-shared-")
        sc.setCheckpointDir(set_dir)
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(set_dir)
    return set_dir


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder; Spark's cleaner removes them when unused."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns only, whatever else the table holds."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of ``fresh_path`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove shuffle files and checkpoints that nothing refers to any more.

    The cleaner acts when the driver collects garbage, which a driver with little to do may not do for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
