"""Near-duplicates against brute force over all pairs of sets."""

import re

import numpy as np

from tilewright.llm import op09_minhash as m

DOCS = "doc_id long, text string, lang string, source string, sig string, rep long"


def brute(rows, size, percent):
    """doc_id to (n_shingles, component), from all pairs."""
    sets = {}
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 2, 80)
    got = m.op9_minhash_near_dedup(spark, medium).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(want)


def test_chain_and_blocks(spark, monkeypatch):
    """A chain of near copies whose ends are unlike, in buckets of several blocks."""
    monkeypatch.setattr(m, "BLOCK", 8)
    w = [f"w{k}" for k in range(400)]
    rows = [(1000 - k, " ".join(w[k : k + 60])) for k in range(60)]
    rows += [(2000 + k, " ".join(w[100:160] + [f"x{k}_{j}" for j in range(10 + k % 7)])) for k in range(40)]
    got = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2, 80)


def test_dense_buckets(spark, monkeypatch):
    """Thousands of classes that share a boilerplate, and so buckets, but only some of them near copies: split by a
    second band, then compared in blocks; also by blocks alone."""
    monkeypatch.setattr(m, "BLOCK", 128)
    rng = np.random.default_rng(5)
    plate = [f"p{k}" for k in range(200)]
    rows = []
    for k in range(720):  # 0.76 alike by the boilerplate alone
        own = [f"o{k - (k % 12 == 1)}_{j}" for j in range(31)]
        rows.append((k if k % 12 != 1 else 5000 - k, " ".join(plate + own + ([f"z{k}"] if k % 12 == 1 else []))))
    order = rng.permutation(len(rows))
    df = spark.createDataFrame([rows[k] for k in order], "doc_id long, text string").repartition(4)
    sets = {d: frozenset(zip(t.split(), t.split()[1:], strict=False)) for d, t in rows}
    twins = {5000 - k: k - 1 for k in range(720) if k % 12 == 1}
    want = {d: twins.get(d, d) for d in sets}
    for d, twin in twins.items():
        x, y = sets[d], sets[twin]
        assert 100 * len(x & y) >= 80 * len(x | y)
    for a, b in rng.choice(sorted(sets), (300, 2)).tolist():
        x, y = sets[a], sets[b]
        assert want[a] == want[b] or 100 * len(x & y) < 80 * len(x | y)
    for dense in (200, 10_000):
        monkeypatch.setattr(m, "DENSE", dense)
        got = m.near_duplicates(df, 2, 80).collect()
        assert {r.doc_id: r.component_id for r in got} == want


def test_one_large_group(spark):
    """Near copies of one text make a star: about a link for each, whatever the size of the group."""
    rng = np.random.default_rng(6)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(1500):
        w = base.copy()
        w[int(rng.integers(0, 100))] = f"x{k}"
        rows.append((k, " ".join(w)))
    got = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2, 80).collect()
    assert {r.component_id for r in got} == {0}


def test_edges(spark):
    rows = [
        (1, None, None, None, "a", 1), (2, "", "en", "s", "a", 1), (3, " \t\n", "en", "s", "a", 1), (4, "Word", "en", "s", "a", 1), (5, "word", None, "s", "a", 1),
        (6, "a b c", "en", "s", "a", 1), (6, "d e f", "en", "s", "a", 1), (7, "A b\nC", "en", "s", "a", 1), (8, "d e  f", "en", None, "a", 1), (None, "a b c", "en", "s", "a", 1), (9, "x " * 40000, "en", "s", "a", 1),
    ]
    got = m.near_duplicates(spark.createDataFrame(rows, DOCS), 2, 80)
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got.collect()) == sorted([
        (0, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 2, 6, True), (6, 2, 6, True), (7, 2, 6, False), (8, 2, 6, False), (9, 1, 9, True),
    ], key=lambda r: (r[0], r[1], r[2] or 0))
    assert m.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_group_with_strangers(spark, monkeypatch):
    """Near copies of one text, and texts that share most of its buckets but no link with it: each class of the group is
    sent to be compared about once, not once for each bucket."""
    rng = np.random.default_rng(7)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(440):
        w = base.copy()
        for at in rng.choice(50, 1 if k < 400 else 7, replace=False).tolist():
            w[2 * at] = f"x{k}_{at}"
        rows.append((k, " ".join(w)))
    sent, dealt = [], m._dealt

    def counted(left):
        out = dealt(left)
        sent.append((out.count(), left.select("rep").distinct().count()))
        return out

    monkeypatch.setattr(m, "_dealt", counted)
    monkeypatch.setattr(m, "BLOCK", 100)
    got = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2, 80)
    assert len({r.component_id for r in got}) > 20
    assert sent and all(n <= 4 * classes for n, classes in sent)
