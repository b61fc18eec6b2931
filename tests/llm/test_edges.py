"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns; and rows by brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tilewright.llm import op01_mix, op03_toxicity, op05_secrets, op08_fingerprint, op10_preferences, queries
from tilewright.llm.bigru import train

LONG = "lorem ipsum dolor " * 20000


def test_mix(spark):
    rows = [(1, "a b", "en", "s1"), (1, "c", "en", "s1"), (2, None, "en", "s1"), (3, "", "de", "s2"), (None, "x y z", None, None), (4, " \t", "en", "s1"), (5, LONG, "en", "s1"), (6, "one", "fr", "s3")]
    df = spark.createDataFrame([(*r, 9, "e") for r in rows], "doc_id long, text string, lang string, source string, tokens int, epoch string")
    flat = [F.lit(1)] * 3
    got = {(r.doc_id, r.epoch): (r.tokens, r["take"], r.lang) for r in op01_mix.mix(df, F.lit("d"), flat, 1.0, 1).collect()}
    assert got == {(1, 0): (3, 3, "en"), (None, 0): (3, 3, "(none)"), (5, 0): (60000, 60000, "en"), (6, 0): (1, 1, "fr")}
    half = op01_mix.mix(df, F.lit("d"), flat, 0.5, 3).collect()
    assert sum(r["take"] for r in half) <= 30003 and all(r["take"] <= r.tokens for r in half)
    assert max(r.epoch for r in half) == 2  # small leaves give all of their epochs, and the rest goes to the large one
    assert op01_mix.mix(df.limit(0), F.lit("d"), flat).count() == 0
    counts = spark.createDataFrame([(t,) for t in ("", " ", "a", " a ", "a\n\nb", None, "é x y")], "t string").select(op01_mix.n_words(F.col("t")))
    assert [r[0] for r in counts.collect()] == [0, 0, 1, 1, 2, 0, 2]


def test_mix_hits_its_budgets(spark, small):
    rows = op01_mix.op1_mix_sources(spark, small)
    total = spark.read.parquet(f"{small}/documents.parquet").agg(F.sum(op01_mix.n_words(F.col("text")))).first()[0]
    assert 0.99 * total < rows.agg(F.sum("take")).first()[0] <= total


def test_toxicity(spark):
    texts = [("you are a fool " if k % 3 == 0 else "good day to you ") + f"number {k} " * (k % 9) for k in range(300)]
    model = train([t.encode() for t in texts], np.arange(300) % 3 == 0)
    rows = [(1, "such a fool"), (2, "good day"), (3, None), (4, ""), (5, " .,! "), (None, "fool"), (6, "good " * 50000 + "fool " + "day " * 50000), (6, "good day")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = [(r.doc_id, r.predicted) for r in op03_toxicity.score(df, model).collect()]
    assert got == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 0), (None, 1), (6, 1), (6, 0)]
    assert [r.doc_id for r in op03_toxicity.keep_clean(df, model).collect()] == [2, 3, 4, 5, 6]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in op03_toxicity.toxicity(df, labels).collect()} == {0}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (99, 0)], "doc_id long, toxic int")
    assert op03_toxicity.toxicity(df, odd).count() == len(rows) and op03_toxicity.toxicity(df.limit(0), odd).count() == 0


def test_held_out_accuracy(spark, medium):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    rows = [r for r in op03_toxicity.op3_toxicity(spark, medium).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.9


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(t):
    out = [("assign", m) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    out = sorted((m.start(), kinds.index(k), m.end()) for k, m in out)
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in out)


def test_secrets(spark):
    h = "0123456789abcdef" * 3
    texts = [f"token = \"{h}\" é😀 API_KEY:'x.y=z123'", None, "", f"😀{h} secret=token:abcdefgh", "AKIA" + "Q" * 16 + " AKIAQ", f"passwd = short {h[:23]}G{h[:24]}", f"bare {h} and token={h}x", LONG + f"Token=é apikey = {h[:30]}", "a" * 30000, "ſecret=abcdefgh", "token=AKIA" + "0123456789" * 3 + " x", "x=" + "word " * 200_000 + "api-key=abcdefghij" + " AKIA" + "Z" * 40_000]
    rows = [(k, t, "en", f"s{k % 2}") for k, t in enumerate(texts)] + [(0, texts[0], None, None), (None, texts[0], "en", "s9")]
    df = spark.createDataFrame([(*r, 1, "e") for r in rows], "doc_id long, text string, lang string, source string, row int, kind string")
    got = sorted((str(r.doc_id), r.base_sha256, r.n_assign + r.n_access + r.n_hex) for r in op05_secrets.secrets(df).collect())
    bases = [(d, base_spans(t or "")) for d, t, _, _ in rows]
    assert got == sorted((str(d), hashlib.sha256(b.encode()).hexdigest(), len(b.split(",")) if b else 0) for d, b in bases)
    assert op05_secrets.secrets(df.limit(0)).count() == 0 and op05_secrets.redact(df).columns == df.columns
    masked = {r.doc_id: r.text for r in op05_secrets.redact(df.where("doc_id in (1, 4)")).collect()}
    assert masked == {1: None, 4: "[SECRET] AKIAQ"}


def test_fingerprints(spark):
    texts = ["", None, "one", "a b a b a b a b", LONG, "x y z w " * 30, "x y z w " * 30, "日本 語 😀 é", "a  b\ta"]
    rows = [(k * 7, t) for k, t in enumerate(texts)] + [(7, "again"), (7, "again"), (None, "first of all")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, fingerprint string").repartition(3)
    got = op08_fingerprint.fingerprints(df).collect()
    assert len(got) == len(rows)
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(r.n_chars)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 8 * op08_fingerprint.ENTRIES
    by = {r.doc_id: r for r in got}
    assert by[35].fingerprint == by[42].fingerprint and by[35].near_next == 1.0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    if True:  # ids that stand once, before one that does
        t, n = texts[4], texts[5]
        q = len(t) // 4
        assert by[28].edited_sha256 == hashlib.sha256((t[: len(t) - q] + n[:q]).encode()).hexdigest()
        t, n = texts[8], order[0][1]
        assert by[56].edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest()
    assert op08_fingerprint.fingerprints(df.limit(0)).count() == 0
    one = op08_fingerprint.fingerprints(spark.createDataFrame([(1, "abcd efgh")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest() and one.near_next == 1.0


def spark_hash(*values):
    """Spark's xxhash64 of longs, ints and strings: each one seeds the next."""
    out = 42
    for kind, v in values:
        raw = v.encode() if kind == "s" else v.to_bytes(8 if kind == "l" else 4, "little", signed=True)
        out = xxhash.xxh64_intdigest(raw, out)
        out -= (out >> 63) << 64
    return out


def plain_signature(text, entries):
    """A signature from the definition: numbered k-mers, each function's order, its two ends in the order of the text."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    k = 2
    if w and len(text) > 32 * len(w):
        w, k = list(text), 6
    grams = [w[i : i + k] for i in range(len(w) - k + 1)] or ([[" ".join(w)]] if w else [])
    seen, numbered = {}, []
    for g in grams:
        top = spark_hash(*[("s", x) for x in g]) >> 31
        c = seen[top] = seen.get(top, -1) + 1
        numbered.append(top if c == 0 else spark_hash(("l", top), ("i", c)) >> 31)
    sig = []
    for j in range(entries):
        if not numbered:
            sig.append(spark_hash(("i", j)))
            continue
        order = sorted((spark_hash(("l", v), ("i", j)) >> 31, place) for place, v in enumerate(numbered))
        x, y = order[0], order[-1]
        if x[1] > y[1]:
            x, y = y, x
        sig.append(spark_hash(("l", x[0]), ("l", y[0]), ("i", j)))
    return sig


def test_signatures(spark):
    """Fingerprints and likenesses against a plain version, on repeats, long words, one word and none."""
    rng = np.random.default_rng(4)
    texts = ["", " \n", "one", "a b", "a b " * 60, "a " * 50, "日本語" * 100, "x" * 500 + " y", "é😀 ß\tb  c", " ".join(f"w{k % 9}" for k in range(200))]
    texts += [" ".join(f"v{rng.integers(0, 40)}" for _ in range(rng.integers(1, 120))) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in op08_fingerprint.fingerprints(df).collect()}
    digits = lambda sig: "".join(f"{(x & (2**62 - 1)) | 2**62:016x}"[8:] for x in sig)
    plain = [plain_signature(t, op08_fingerprint.ENTRIES) for t in texts]
    for k, t in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        q = len(t) // 4
        edited = plain_signature(t[: len(t) - q] + after[:q], op08_fingerprint.ENTRIES)
        assert got[k].fingerprint == digits(plain[k]) and got[k].edited_fingerprint == digits(edited)
        assert got[k].near_edited == np.mean([x == y for x, y in zip(plain[k], edited, strict=True)])
        assert got[k].near_next == np.mean([x == y for x, y in zip(plain[k], plain[(k + 1) % len(texts)], strict=True)])


def test_occurrences_are_numbered(spark):
    """The k-mers of a text with repeats, as many as it has, all different; and a prefix keeps those it shares."""
    kmers = lambda t: spark.createDataFrame([(t,)], "t string").select(op08_fingerprint.numbered_kmers(F.col("t")).alias("k")).first().k
    for text in ("a b " * 50, "a " * 40, "x y z", " ".join(f"w{k % 9}" for k in range(200))):
        w = text.split()
        got = kmers(text)
        assert len({v >> 31 for v in got}) == len(w) - 1 and sorted(v & (2**31 - 1) for v in got) == list(range(len(w) - 1))
        some = kmers(" ".join(w[: len(w) // 2 + 1]))
        assert {v >> 31 for v in some} < {v >> 31 for v in got}


def test_preferences(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (0, 0, "user", "q"), (0, 1, "assistant", "a1"), (0, 2, "user", "q2"), (0, 3, "assistant", "a2"), (4, 0, "user", None), (4, None, None, "x"), (6, 0, "assistant", ""), (None, 0, "user", "n"), (8, 0, "assistant", "z"), (8, 0, "assistant", "z"), (9, 5, "assistant", "z")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, prompt string")
    got = {r.conv_id: r for r in op10_preferences.format_pairs(op10_preferences.worse_reply(df), "conv_id").collect()}
    r = got[0]
    assert (r.n_common, r.prompt, r.rejected, r.rejected_mask) == (1, "<|user|>\nq<|end|>\n", "<|assistant|>\nyo<|end|>\n", "14+10")
    assert r.chosen == "<|assistant|>\na1<|end|>\n<|user|>\nq2<|end|>\n<|assistant|>\na2<|end|>\n" and r.chosen_mask == "14+10,19+0,14+10"
    turns = lambda *t: [(k, role, text) for k, (role, text) in enumerate(t)]
    kind = "array<struct<turn:bigint,role:string,text:string>>"
    a, b, c = ("user", "q"), ("assistant", LONG), ("assistant", "no")
    pairs = spark.createDataFrame([(1, turns(a, b, a), turns(a, b)), (2, turns(a), turns(b, a)), (3, turns(a, b, a, c), turns(a, c, a, c)), (4, None, turns(a)), (5, turns(), None)], f"k int, chosen {kind}, rejected {kind}")
    got2 = {r.k: r for r in op10_preferences.format_pairs(pairs, "k").collect()}
    assert [got2[k].n_common for k in (1, 2, 3, 4, 5)] == [2, 0, 1, 0, 0] and got2[1].rejected == "" and got2[1].chosen == "<|user|>\nq<|end|>\n" and got2[5].prompt == ""
    assert got2[3].chosen.count("<|end|>") == 3 and len(got2[1].prompt) > len(LONG)
    assert got[4].n_common == 2 and got[4].chosen == "" and got[4].chosen_mask == "" and got[9].chosen == "" and got[8].chosen == "<|assistant|>\nz<|end|>\n" and got[8].rejected == ""
    assert op10_preferences.format_pairs(op10_preferences.worse_reply(df.limit(0)), "conv_id").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, small, name):
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    got = queries.QUERIES[name](spark, small)
    columns = sorted(got.columns)
    want = c.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    rows = c.sql(f"select {', '.join(columns)} from ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, rows))
