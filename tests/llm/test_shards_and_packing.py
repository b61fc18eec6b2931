"""Tokens, shards and packing: exact round trips."""

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tilewright.llm import op02_shards as s
from tilewright.llm import op04_pack as p
from tilewright.llm._numpy_text import text_bytes
from tilewright.llm._shared import fresh_path
from tilewright.llm.word_bpe import public_path, word_bpe

ODD = [(None, None), (1, ""), (1, "again it's"), (2, None), (3, "word " * 9000), (4, "ab<|endoftext|>c"), (5, "日本 É̀ ß ²x"), (6, "again it's")]


LIBRARY = Tokenizer.from_file(public_path())


def tokens(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def test_tokenizer():
    rng = np.random.default_rng(0)
    letters = list("abcstmdrevl' '''\"?!.,  \t\n0129²½ªµ×÷ÀÞßéñÿ\x85\xa0\xad_-<|>\x1c\x00ABZŒſİ日́😀")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)] + ["a" * 3000, "'s'll'd", "x'vex"]
    plain = ["".join(c for c in t if ord(c) < 256 and c != "|") for t in texts]
    library = Tokenizer.from_file(public_path())
    for some in (texts, plain):
        got = word_bpe(public_path()).encode(*text_bytes(pa.array(some)))
        assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_feistel():
    for n in (1, 2, 3, 17, 1000, 70000):
        got = s.feistel(np.arange(n), n, 5)
        assert sorted(got.tolist()) == list(range(n))
        assert n < 1000 or (got != s.feistel(np.arange(n), n, 6)).any()


def test_shards(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5).cache()
    want = {r.doc_id: tokens(r.text) for r in docs.collect()}
    out = fresh_path(spark, "shards")
    index = s.materialise(docs, out, length=128, per_shard=50).collect()
    records = list(s.read_slots(spark, out))
    assert sorted(r.slot for r in index) == list(range(len(records)))
    got = defaultdict(dict)
    for r in index:
        body = records[r.slot]
        assert zlib.crc32(body.tobytes()) == r.ids_crc32 and (r.shard, r.byte) == (r.slot // 50, r.slot % 50 * 257)
        at = 0
        for x in r.pieces:
            got[x.doc_id][x.start] = body[at : at + x.length].tolist()
            at += x.length
        assert at == r.n_tokens and not body[at:].any()
    assert {d: [i for k in sorted(parts) for i in parts[k]] for d, parts in got.items()} == want
    assert [a.tolist() for a in s.read_slots(spark, out, 73, 60)] == [a.tolist() for a in records[73:133]]
    assert s.materialise(docs.limit(0), fresh_path(spark, "shards")).count() == 0
    odd = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, slot string").repartition(3).cache()
    out = fresh_path(spark, "shards")
    index = s.materialise(odd, out, 64, 7).collect()
    records = list(s.read_slots(spark, out))
    got = defaultdict(int)
    for r in index:
        at = 0
        for x in r.pieces:
            got[x.doc_id] += x.length
            at += x.length
        assert at == r.n_tokens and not records[r.slot][at:].any() and zlib.crc32(records[r.slot].tobytes()) == r.ids_crc32
    want = defaultdict(int)
    for d, t in ODD:
        want[d] += len(tokens(t))
    assert got == want and sum(r.n_tokens for r in index) == sum(want.values())


def test_wide_ids(spark):
    """Ids that don't fit 16 bits stop the job rather than wrap."""
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="16 bits"):
        s.materialise(docs, fresh_path(spark, "shards"), end_id=70_000)


def check_packing(rows, docs, capacity):
    pieces = sorted((str(d), i[0], len(i), zlib.crc32(np.array(i, "<u4"))) for d, t in docs for ids in [tokens(t)] for i in [ids[k : k + capacity] for k in range(0, len(ids), capacity)])
    assert sorted((str(r.doc_id), r.length, r.ids_crc32) for r in rows) == sorted((d, n, c) for d, _, n, c in pieces)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.start == r.piece * capacity
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").repartition(40)
    rows = p.pack(docs, 512).collect()
    n = check_packing(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 512)
    assert n <= 1.01 * sum(r.length for r in rows) / 512 + 1
    odd = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, bin string").repartition(3)
    check_packing(p.pack(odd, 4096).collect(), ODD, 4096)
    assert p.pack(odd.limit(0)).count() == 0


def test_best_fit():
    bins, places, filled = p.best_fit(np.array([5, 3, 3, 7, 2, 8]), 10)
    assert filled.tolist() == [10, 10, 8] and bins.tolist() == [2, 1, 2, 1, 0, 0] and places.tolist() == [0, 7, 5, 0, 8, 0]


def plain_best_fit(sizes, capacity):
    bins, rooms = [0] * len(sizes), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= sizes[k]]
        b = min(fits)[1] if fits else len(rooms)
        rooms += [] if fits else [capacity]
        rooms[b] -= sizes[k]
        bins[k] = b
    return bins, [capacity - r for r in rooms]


def test_best_fit_by_runs():
    """The plan on the histogram is item by item best fit."""
    rng = np.random.default_rng(3)
    for n, capacity in ((0, 9), (1, 9), (50, 1), (200, 40), (400, 100), (600, 4096), (300, 7), (500, 64)):
        sizes = rng.integers(1, capacity + 1, n) // rng.integers(1, 9) + 1
        sizes = np.minimum(sizes, capacity)
        bins, places, filled = p.best_fit(sizes, capacity)
        want = plain_best_fit(sizes.tolist(), capacity)
        assert (bins.tolist(), filled.tolist()) == want
        at = [0] * len(filled)
        for k in sorted(range(n), key=lambda k: -sizes[k]):
            assert places[k] == at[bins[k]]
            at[bins[k]] += int(sizes[k])


def test_tree_of_nodes():
    """The moves of a node place each piece that doesn't go on, and number those that do."""
    rng = np.random.default_rng(7)
    for capacity, slack in ((40, 2), (100, 0), (300, 300), (64, 64)):
        rows = [(5, child, length, int(rng.integers(1, 9))) for child in (80, 81, 85) for length in rng.choice(np.arange(1, capacity + 1), min(capacity, 30), replace=False).tolist()]
        got = p._merged(capacity, slack)(pd.DataFrame(rows, columns=["node", "child", "length", "n"]))
        sizes = np.array([length for _, _, length, n in sorted(rows, key=lambda r: (-r[2], r[1])) for _ in range(n)])
        bins, offsets, filled = p.best_fit(sizes, capacity)
        key = [(length, child, k) for _, child, length, n in sorted(rows, key=lambda r: (-r[2], r[1])) for k in range(n)]
        went = defaultdict(int)
        seen = {}
        for r in got.itertuples():
            for k in range(r.n):
                seen[r.length, r.child, r.first + k] = ("open", r.shift + k) if r.is_open else (r.bin + (r.shift + k) // r.each, r.before + (r.shift + k) % r.each * r.length)
        for (length, child, k), b, offset in zip(key, bins.tolist(), offsets.tolist(), strict=True):
            if filled[b] < capacity - slack:
                assert seen[length, child, k] == ("open", went[length])
                went[length] += 1
            else:
                assert seen[length, child, k] == (b, offset)
        assert len(seen) == len(key)


@pytest.mark.parametrize("fan", [2, 16])
def test_packing_of_unlike_splits(spark, monkeypatch, fan):
    """Splits of long pieces meet those of short ones, however many there are: nearly as few sequences as one best fit over all has."""
    monkeypatch.setattr(p, "FAN", fan)
    rng = np.random.default_rng(4)
    n = 32 * 1500
    part = np.arange(n) // 1500
    words = np.where(part % 2 == 0, rng.integers(140, 161, n), rng.integers(95, 106, n))
    docs = spark.createDataFrame([(k, int(w)) for k, w in enumerate(words)], "doc_id long, w int").repartitionByRange(32, "doc_id")
    rows = p.pack(docs.selectExpr("doc_id", "trim(repeat('the ', w)) as text"), 409).select("doc_id", "length", "sequence_id", "offset").toPandas()
    assert len(rows) == n and sorted(rows.doc_id) == list(range(n))
    got = rows.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    filled = rows.groupby("sequence_id").length.sum()
    want = p.best_fit(rows.length.to_numpy(np.int64), 409)[2]
    assert filled.max() <= 409 and len(filled) <= 1.01 * len(want)
    assert len(filled) <= 1.1 * rows.length.sum() / 409
