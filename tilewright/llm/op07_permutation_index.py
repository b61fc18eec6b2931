"""Approximate nearest neighbours by a permutation index.

A bounded sample of the vectors gives the pivots. Each vector is represented by the order of its nearest
pivots by direction, and posted in the inverted file of each of its ``POSTED`` nearest ones. A query reads the files of
its own nearest pivots, and scores all that it finds by exact inner products in double precision. There is
no choice by the two orders before that: a footrule over all pivots costs more than the inner product, and
where many pivots lie in one tight group their mutual order, which is noise, decides it.

Very long vectors have large inner products with queries of other directions too: the longest are posted
in a file of their own instead, which every query reads.

Equal vectors are one entry of the index, with the smallest ids of those that hold it, as more can't be
among the results. A pivot's file is dealt out in blocks of ``BLOCK`` entries by ``BLOCK`` queries, so that
a pivot that is near to very many vectors is many tasks. A vector is scored in the file of the first pivot
of the query's order that it is posted under, and nowhere else.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import cut, table

#: Pivots: so many, and with very many vectors (square root of their number) / 4, as long as they have so many bytes at most.
PIVOTS, PIVOT_BYTES = 256, 64 << 20
#: Nearest pivots that a vector is posted under, and that a query reads.
POSTED = 16
#: So many of the longest vectors, at most one of 16, are in the file that every query reads.
LONGEST = 1024
#: Entries and queries of a task.
BLOCK = 4096


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """The ``n`` vectors with the smallest hash: a sample of fixed size."""
    rows = vectors.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(n).select("vector").collect()
    return np.array([r.vector for r in rows], np.float64)


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _orders(pivots: np.ndarray):
    """(vec_id, vector, is_long) to (vec_id, vector, near): the files that hold it, and (qnear) those that it reads as a query.

    Files are the nearest pivots in order. The one after all pivots holds the longest vectors, which are in no other.
    """
    aimed = _directions(pivots)

    def run(batches):
        for rows in batches:
            x = np.stack(rows.vector.to_numpy()).astype(np.float64) if len(rows) else np.ones((0, pivots.shape[1]))
            order = np.argsort(-(_directions(x) @ aimed.T), axis=1, kind="stable")[:, :POSTED].astype(np.int32) if len(rows) else []
            last = np.array([len(pivots)], np.int32)
            rows["near"] = [last if long else o for o, long in zip(order, rows.is_long, strict=True)]
            rows["qnear"] = [np.append(o, last) for o in order]
            rows["vector"] = [v.astype("<f8").tobytes() for v in x]
            yield rows[["vec_id", "vector", "is_query", "near", "qnear"]]

    return run


def _search(found: int, n_files: int):
    """One block of a pivot's file and one of queries: each query's best entries, all of them scored."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        entries, queries = rows[~rows.asks], rows[rows.asks]
        out = {"query": [], "entry": [], "score": []}
        if len(entries) and len(queries):
            pivot = int(rows["pivot"].iloc[0])
            read = lambda col, kind: np.frombuffer(b"".join(col), kind).reshape(len(col), -1)
            vectors, ids = read(entries.vector, "<f8"), entries.vec_id.to_numpy()
            near = np.stack(entries.near.to_numpy())
            for q_id, q_near, q in zip(queries.vec_id, queries.near, read(queries.vector, "<f8"), strict=True):
                earlier = np.zeros(n_files, bool)
                earlier[q_near[: np.flatnonzero(q_near == pivot)[0]]] = True
                mine = np.flatnonzero(~earlier[near].any(1))
                score = (vectors[mine] * q).sum(1)
                if len(mine) > found:
                    high = np.flatnonzero(score >= np.partition(score, -found)[-found])
                    mine, score = mine[high], score[high]
                best = np.lexsort((ids[mine], -score))[:found]
                out["query"].append(np.full(len(best), q_id))
                out["entry"].append(ids[mine[best]])
                out["score"].append(score[best])
        return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}).astype({"query": "int64", "entry": "int64", "score": "float64"})

    return run


def nearest(vectors: DataFrame, is_query, n: int = 20) -> DataFrame:
    """The ``n`` entries with the largest inner product found for each query, its own row left out.

    ``vectors``: vec_id, embedding; other columns are ignored. Rows whose id is null, or whose vector is null,
    empty, zero, holds null or non-finite components, or hasn't the most common number of components, take no
    part. Returns query_id, rank, vec_id, score; ties go to the smaller vec_id. A vec_id that several rows
    repeat with the same vector counts once.
    """
    spark = vectors.sparkSession
    v = F.col("vector")
    rows = vectors.where("vec_id is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("is_query"))
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.coalesce(sound, F.lit(False)))
    width = rows.groupBy(F.size(v).alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size(v) == width.w).withColumn("h", F.md5(F.array_join(v, ",")))
    # A class of equal vectors: its smallest ids, one more than results are asked for.
    by_id = Window.partitionBy("h").orderBy("vec_id")
    members = cut(rows.select("h", "vec_id").distinct().withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= n + 1))
    classes = rows.groupBy("h").agg(F.min("vec_id").alias("vec_id"), F.max("is_query").alias("is_query"))
    entries = cut(rows.select("h", "vec_id", "vector").join(classes, ["h", "vec_id"]).dropDuplicates(["h"]))
    count = entries.count()
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    long = entries.select(square.alias("s")).orderBy(F.desc("s")).limit(1 + min(LONGEST, count // 16)).agg(F.min("s")).first()[0]
    pivots = _pivots(entries, max(PIVOTS, min(PIVOT_BYTES // (8 * width.w), math.isqrt(count) // 4)))
    kinds = "vec_id long, vector binary, is_query boolean, near array<int>, qnear array<int>"
    index = cut(entries.select("vec_id", "vector", "is_query", (square > F.lit(long)).alias("is_long")).mapInPandas(_orders(pivots), kinds))
    n_files = len(pivots) + 1

    # Sizes of the files, one for each, tell how many blocks each one gets.
    def blocks(near: str, of: DataFrame) -> F.Column:
        got = {r.pivot: r.n for r in of.select(F.explode(near).alias("pivot")).groupBy("pivot").agg(F.count("*").alias("n")).collect()}
        return F.get(F.array(*[F.lit(max(1, -(-got.get(p, 0) // BLOCK))) for p in range(n_files)]), F.col("pivot"))

    asking = index.where("is_query")
    of_entries, of_queries = blocks("near", index), blocks("qnear", asking)
    some = lambda x: F.sequence(F.lit(0), x - 1)
    posts = index.select("vec_id", "vector", "near", F.explode("near").alias("pivot")).withColumn("e", F.pmod(F.xxhash64("vec_id"), of_entries).cast("int"))
    posts = posts.withColumn("q", F.explode(some(of_queries))).withColumn("asks", F.lit(False))
    asked = asking.select("vec_id", "vector", F.col("qnear").alias("near"), F.explode("qnear").alias("pivot")).withColumn("q", F.pmod(F.xxhash64("vec_id"), of_queries).cast("int"))
    asked = asked.withColumn("e", F.explode(some(of_entries))).withColumn("asks", F.lit(True))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = posts.unionByName(asked).repartition(4 * n_parts, "pivot", "e", "q")
    found = dealt.groupBy("pivot", "e", "q").applyInPandas(_search(n + 1, n_files), "query long, entry long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    found = cut(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n + 1).drop("r"))

    # From classes to rows: the members of those found, then each query of the asking class but itself.
    h_of = entries.select("h", F.col("vec_id").alias("entry"))
    ids = found.join(h_of, "entry").join(members.select("h", "vec_id"), "h").drop("h")
    ids = cut(ids.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= n + 1).select("query", "vec_id", "score"))
    best = ids.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("best"))
    best = cut(best.join(entries.select("h", F.col("vec_id").alias("query")), "query").select("h", "best"))
    asked = cut(rows.where("is_query").select("h", F.col("vec_id").alias("query_id")).distinct())
    own = asked.join(best, "h").select("query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, n).alias("best"))
    out = own.select("query_id", F.posexplode("best").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.minus")).alias("score"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
