"""Toxicity of whole texts, by the network of ``bigru``: fitted by one task, applied by every task.

Labels come only from rows whose crc32(doc_id as text) mod 5 isn't 0. The network is fitted on a bounded
sample of them: for each label the rows with the smallest hash of their id, ``MOST_TOXIC`` and
``MOST_CLEAN`` at most, of texts up to ``MOST_CHARS`` characters. One task gathers them and fits the
network, and the driver gets the weights only, which have a fixed size. Scoring reads every window of every
text and needs no shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._numpy_text import text_bytes
from ._shared import bound_batches, table, texts
from .bigru import Model, train

#: Bounds of the training sample.
MOST_TOXIC, MOST_CLEAN, MOST_CHARS = 1500, 2500, 20_000
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, most_chars: int = MOST_CHARS) -> Model:
    """The network, fitted to the sample above. Rows with a null id, label or text are left out; a doc_id
    with several labels counts as toxic if one says so. Without labels of both kinds every text gets the same score."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sample = None
    for label, most in ((1, most_toxic), (0, most_clean)):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        sample = part if sample is None else sample.unionByName(part)
    # The sample has at most most_toxic + most_clean rows of two numbers: broadcasting it is bounded.
    rows = texts(docs).where(F.length("text").between(1, most_chars)).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    fitted = rows.repartition(1).mapInArrow(_train, "model binary").first()
    return pickle.loads(fitted.model) if fitted else train([], np.zeros(0, np.int64))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows (doc_id, text, toxic), in whatever order, to the fitted network."""
    rows = sorted((d, t, y) for b in batches for d, t, y in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True))
    model = train([t.encode() for _, t, _ in rows], np.array([y for *_, y in rows], np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Returns doc_id, held_out, score, predicted for each row of ``docs``; a text without words scores 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores)], ["doc_id", "score"])

    out = texts(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, whole, whose score is under 0.5."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(*text_bytes(batch.column("text"))) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits and scores. Columns of ``docs`` besides doc_id and text are ignored."""
    return score(docs, fit(docs, labels))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
