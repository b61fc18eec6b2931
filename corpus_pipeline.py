"""A training corpus from ``documents``: stages that each take what the one before kept.

Toxic documents go; of near copies (five-word shingles, similarity 0.8 or more) one stays; credentials
that aren't widely copied examples are masked; sources are mixed to target weights; and the rest is packed
into sequences of 4096 tokens. Each stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import op01_mix, op03_toxicity, op04_pack, op05_secrets, op09_minhash
from tilewright.llm._shared import fresh_path, remove, table

#: Share of all tokens that the mixture takes.
SHARE = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03_toxicity.keep_clean(docs, op03_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op09_minhash.one_of_each(docs, size=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op05_secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op01_mix.mixed(docs, F.expr(op01_mix.DOMAIN_SQL), [F.expr(w) for w in op01_mix.WEIGHTS_SQL], SHARE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op04_pack.pack(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secrets", secrets), ("mixture", mixture), ("packing", packing)]

#: The network of the first stage can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's rows are written to the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
