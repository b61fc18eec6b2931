"""The permutation index against brute force."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tilewright.llm import op07_permutation_index as m


def brute(rows, n):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for k in np.flatnonzero(ids % 20 == 0):
        s = (x * x[k]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[k]][:n]
        out[int(ids[k])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark, medium):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{medium}/embeddings.parquet").collect()]
    got, want = results(m.op7_permutation_index(spark, medium)), brute(rows, 20)
    assert got.keys() == want.keys()
    share = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert share >= 0.95
    exact = dict(rows)
    for q, found in got.items():
        assert len(found) == 20 and all(abs(s - np.dot(np.array(exact[q], float), np.array(exact[i], float))) < 1e-12 for i, s in found)


def test_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 50)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * rng.uniform(0.5, 2, (300, 1))
    x[40:140] = x[40]
    rows = [(k, x[k].tolist()) for k in range(300)]
    odd = [(1000, None), (1020, [0.0] * 8), (1040, [None] * 8), (1060, [float("nan")] * 8), (1080, []), (1100, [1.0]), (None, [1.0] * 8), (60, x[60].tolist())]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id long, embedding array<double>, rank int, h string")
    got, want = results(m.nearest(df, F.col("vec_id") % 20 == 0)), brute(rows, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert [i for i, _ in got[40]] == [i for i, _ in want[40]] and [i for i, _ in got[100]] == [i for i, _ in want[100]]
    few = m.nearest(df.where("vec_id < 3"), F.col("vec_id") % 20 == 0)
    assert [i for i, _ in results(few)[0]] == [i for i, _ in brute(rows[:3], 20)[0]]
    assert m.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_ties_at_the_last_rank(spark):
    """Of different vectors with equal scores the smaller ids are the results."""
    rows = [(0, [1.0, 0.0])] + [(k, [0.5, 0.25 * k]) for k in range(15, 0, -1)]
    got = results(m.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5))
    assert got == {0: [(k, 0.5) for k in range(1, 6)]}


@pytest.mark.parametrize("lengths", ["equal", "uneven", "heavy"])
def test_recall_on_skew(spark, tmp_path, lengths):
    """A third of 40,000 vectors in one tight group: their pivots don't spoil the search for the others."""
    rng = np.random.default_rng(1)
    n, k = 40_000, 20
    x = rng.normal(size=(n, 64))
    group = rng.permutation(n)[: n // 3]
    x[group] = rng.normal(size=64) + 0.1 * x[group]
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= {"equal": np.ones(n), "uneven": rng.uniform(0.5, 2, n), "heavy": rng.lognormal(0, 1, n)}[lengths][:, None]
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": list(x)}), tmp_path / "v.parquet")
    asked = np.arange(0, n, 400)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-score, 1)[:, :k]
    got = results(m.nearest(spark.read.parquet(str(tmp_path / "v.parquet")), F.col("vec_id") % 400 == 0, k))
    share = np.array([len({i for i, _ in got[q]} & set(w)) / k for q, w in zip(asked.tolist(), want.tolist(), strict=True)])
    inside = np.isin(asked, group)
    print(lengths, "inside", share[inside].mean(), "outside", share[~inside].mean())
    assert share[inside].mean() >= 0.95 and share[~inside].mean() >= 0.95
