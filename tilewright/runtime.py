"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset and Spark runs in this process, as in tests, a folder of this machine."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return at or known.get()
    if not at and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    at = at or "file://" + tempfile.mkdtemp(prefix="tilewright-")
    sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and read back from the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``cut``, but compressed and by columns: for rows that are read several times, each time only some of their columns."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
