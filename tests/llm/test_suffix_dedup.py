"""Removal of repeated passages against brute force over all windows."""

import hashlib
from collections import Counter

import numpy as np

from tilewright.llm import op06_suffix_dedup as m
from tilewright.llm.suffix_array import common_prefixes, suffix_array


def brute(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i + 1 : i + width + 1] = True
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]))
        kept = bytes(b for b, g in zip(r, gone[1:], strict=False) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def want(pairs, width):
    return sorted(((d is None, d or 0), *x) for (d, _), x in zip(pairs, brute([t for _, t in pairs], width), strict=True))


def test_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    pairs = [tuple(r) for r in docs.collect()]
    got = rows(m.op6_suffix_dedup(spark, medium))
    assert got == want(pairs, 200)
    assert any(x[2] for x in got)


def test_spread_anchors(spark, monkeypatch):
    """One passage in many documents, in shards of a few contexts, with ties and neighbours of every kind."""
    monkeypatch.setattr(m, "SHARD_CONTEXTS", 4)
    monkeypatch.setattr(m, "SORTED_BYTES", 3000)
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefghij é"), n))
    passage, line = word(700), word(90)
    pairs = [(k, word(int(rng.integers(0, 300))) + passage[k % 7 :] + word(200)) for k in range(60)]
    pairs += [(100 + k, (line + "\n") * int(rng.integers(1, 9)) + word(50)) for k in range(30)]
    pairs += [(200 + k, passage[k : k + 190 + k]) for k in range(30)] + [(300, "x" * 5000), (301, "y" * 199), (302, "z" * 201), (303, "é" * 101)]
    pairs += [(None, word(300)), (None, None), (5, pairs[5][1]), (400, ""), (401, None), (402, passage), (402, passage[:400])]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)
    extra = df.selectExpr("*", "1 as h", "2 as a", "'x' as spans")
    assert rows(m.remove_repeats(extra)) == want(pairs, 200)
    assert m.remove_repeats(df.limit(0)).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n, letters in ((0, 1), (1, 2), (300, 2), (5000, 3), (900, 1)):
        t = rng.integers(97, 97 + letters, n).astype(np.uint8)
        sa, b = suffix_array(t, 200), t.tobytes()
        order = sorted(range(n), key=lambda i: b[i : i + 200])
        assert [b[i : i + 200] for i in sa] == [b[i : i + 200] for i in order]
        same = common_prefixes(t, sa, 200) >= 200
        assert all(same[j] == (b[sa[j - 1] : sa[j - 1] + 200] == b[sa[j] : sa[j] + 200]) for j in range(1, n) if max(sa[j - 1], sa[j]) + 200 <= n)


def test_prefixes_of_suffixes_that_tie():
    """Suffixes that are equal as far as they are sorted, and in the other order a few bytes on."""
    rng = np.random.default_rng(2)
    for letters in (2, 4, 26):
        base = rng.integers(97, 97 + letters, (4, 700))
        parts = []
        for k in range(60):
            parts.append(base[k % 4, rng.integers(0, 300) : rng.integers(560, 701)].copy())
            parts[-1][rng.integers(0, len(parts[-1]))] = 96
        t = np.concatenate(parts).astype(np.uint8)
        sa, b = suffix_array(t, 200), t.tobytes()
        got = common_prefixes(t, sa, 200)
        for j in range(1, len(t)):
            x, y = (b[i : i + 200] for i in sa[j - 1 : j + 1])
            if len(x) == len(y) == 200:
                assert got[j] == next((i for i in range(200) if x[i] != y[i]), 200)


def test_near_copies_and_smallest_id(spark):
    """Passages that share more than 256 bytes and differ in one; the smallest long and null are different ids."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abc"), n))
    base, pairs = [word(1200) for _ in range(5)], []
    for k in range(600):
        text = list(base[k % 5][rng.integers(0, 800) :])
        text[rng.integers(0, len(text))] = "z"
        pairs.append((k, word(rng.integers(0, 150)) + "".join(text) + word(rng.integers(0, 150))))
    pairs += [(-(1 << 63), word(300)), (None, word(300)), (-(1 << 63), base[0]), (None, base[0]), (-(1 << 63), None)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    assert rows(m.remove_repeats(df)) == want(pairs, 200)
