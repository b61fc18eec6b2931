"""Removal of repeated passages: bytes that a string of ``WIDTH`` bytes covers which starts elsewhere, too.

1. Every window of ``WIDTH`` bytes is assigned to its anchor, the 32-byte gram in it with the smallest hash.
   Equal windows have equal anchors, so only occurrences of one anchor need comparing. An occurrence's
   context is the bytes of all windows assigned to it; contexts are first counted by hash, so that copies
   of a passage or of a document cost one row for each anchor, however many there are.
2. Anchors with one occurrence are done. So are contexts that stand elsewhere as they are: all of their
   windows do. One copy of each context of the other anchors is fetched from its text.
3. Contexts are dealt to shards by anchor. A shard's task sorts the suffixes of its contexts (Larsson and
   Sadakane's refinement, in numpy) and finds the windows that repeat from the common prefixes of
   neighbours (Kasai's method).
4. An anchor with more than ``SHARD_CONTEXTS`` different contexts is spread over several shards. Each cuts
   its sorted windows into ranges by binary search, and the tasks that merge a range look each shard's
   windows up in the others' by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._numpy_text import mix64, ranges, row_chunks, text_bytes
from ._shared import cut, fresh_path, release, remove, table, texts
from .suffix_array import common_prefixes, suffix_array
from .winnow import anchors

WIDTH = 200
#: Different contexts of an anchor that one shard holds.
SHARD_CONTEXTS = 1500
#: Bytes of contexts that are sorted at once.
SORTED_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class Spans:
    """Hashes of any spans of some bytes, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.sums[1:])
        power = np.full(n + 1, _INVERSE, np.uint64)
        power[0] = 1
        self.inverse = np.multiply.accumulate(power)

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = (self.sums[start + size] - self.sums[start]) * self.inverse[start]
        return mix64(h ^ (size.astype(np.uint64) << np.uint64(40)))


def _occurrences(width: int):
    """(doc_id, h, text) to (doc_id, h, a, c, first, n): anchor, context, and the windows assigned to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets, 1 << 21):
                part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                _, a, first, last = anchors(part, off, width)
                row = np.searchsorted(off, first, "right") - 1
                n = last - first + 1
                c = Spans(part).of(first, n + width - 1)
                at = pa.array(lo + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("h").take(at), pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array((first - off[row]).astype(np.int64)), pa.array(n.astype(np.int32))],
                    ["doc_id", "h", "a", "c", "first", "n"],
                )

    return run


def _fetch(width: int):
    """(doc_id, h, text, asked) to one row for each asked context, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "c", "first", "n", "times", "salts"]
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            asked = batch.column("asked")
            flat = asked.flatten()
            cols = {k: flat.field(k) for k in names}
            row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
            first, n = cols["first"].to_numpy(), cols["n"].to_numpy().astype(np.int64)
            start, size = offsets[row] + first, n + width - 1
            for k in range(0, len(row), 4096):
                s, z = start[k : k + 4096], size[k : k + 4096]
                at = np.concatenate([[0], np.cumsum(z)]).astype(np.int32)
                body = pa.Array.from_buffers(pa.binary(), len(z), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data[ranges(s, z)].tobytes())])
                here = pa.array(row[k : k + 4096])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(here), batch.column("h").take(here), *[cols[c].slice(k, len(z)) for c in names], body], ["doc_id", "h", *names, "body"])

    return run


def repeated_windows(bodies: np.ndarray, at: np.ndarray, times: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of some contexts (concatenated bytes and offsets; ``times``: how often each context stands).

    Returns the starts of all windows in order of their bytes, each one's class of equal windows, and for
    each class whether it stands twice or more.
    """
    sa = suffix_array(bodies, width)
    same = common_prefixes(bodies, sa, width) >= width
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    is_start = np.arange(len(bodies)) + width <= at[1:][owner]
    klass = np.cumsum(~same)
    keep = is_start[sa]
    sa, klass = sa[keep], np.unique(klass[keep], return_inverse=True)[1]
    return sa, klass, np.bincount(klass, times[owner[sa]].astype(np.float64)) >= 2


def _sorted_shards(width: int):
    """Rows sorted by (a, salt) to spans found (part -1), and the windows of spread anchors by range (part >= 0)."""
    names = ["doc_id", "h", "start", "stop", "a", "part", "body"]

    def solve(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        rows = rows.drop_duplicates(["a", "c"])
        at = np.concatenate([[0], np.cumsum(rows.body.map(len).to_numpy())])
        text = np.frombuffer(b"".join(rows.body), np.uint8)
        sa, klass, twice = repeated_windows(text, at, rows.times.to_numpy(), width)
        owner = np.searchsorted(at, sa, "right") - 1
        doc, h, first = rows.doc_id.to_numpy(), rows.h.to_numpy(), rows["first"].to_numpy() - at[:-1]
        hit = np.sort(sa[twice[klass] & (rows.times.to_numpy() < 2)[owner]])
        if len(hit):
            whose = np.searchsorted(at, hit, "right") - 1
            cuts = np.flatnonzero(np.append(True, (np.diff(hit) > 1) | (np.diff(whose) > 0)))
            ends = np.append(cuts[1:], len(hit)) - 1
            whose = whose[cuts]
            none = np.zeros(len(cuts), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[whose]), pa.array(h[whose]), pa.array(hit[cuts] + first[whose]), pa.array(hit[ends] + first[whose] + width), pa.array(none), pa.array(none - 1), pa.nulls(len(cuts), pa.binary())], names
            )
        salts = rows.salts.to_numpy()
        spread = np.flatnonzero(salts[owner] > 1)
        if not len(spread):
            return
        # One window of each class is enough where the class is known to repeat; it can mark others' windows.
        keys = Spans(text).of(sa[spread], np.full(len(spread), width))
        lead = np.ones(len(spread), bool)
        lead[1:] = klass[spread][1:] != klass[spread][:-1]
        use = ~twice[klass[spread]] | lead
        spread, keys = spread[use], keys[use]
        who = owner[spread]
        table_ = np.rec.fromarrays([rows.a.to_numpy()[who], keys, doc[who], h[who], sa[spread] + first[who], twice[klass[spread]].astype(np.int64)], names="a,key,doc,h,start,known")
        table_ = table_[np.lexsort((table_.key, table_.a))]
        for a in np.unique(table_.a):
            mine = table_[table_.a == a]
            n = int(salts[rows.a.to_numpy() == a][0])
            bounds = np.searchsorted(mine.key, (np.arange(n + 1) * ((1 << 64) / n)).astype(np.float64).clip(0, 2.0**64 - 4096).astype(np.uint64))
            bounds[0], bounds[-1] = 0, len(mine)
            for r in range(n):
                part = mine[bounds[r] : bounds[r + 1]]
                if len(part):
                    body = np.stack([part.key.view(np.int64), part.doc, part.h, part.start, part.known]).astype("<i8").tobytes()
                    yield pa.RecordBatch.from_arrays([*[pa.array([0], pa.int64())] * 4, pa.array([a], pa.int64()), pa.array([r], pa.int64()), pa.array([body], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                rows = batch.slice(k, 512).to_pandas()
                held.append(rows)
                size += int(rows.body.map(len).sum())
            while size > SORTED_BYTES:
                rows = pd.concat(held, ignore_index=True)
                group = (rows[["a", "salt"]].diff().fillna(1) != 0).any(axis=1).to_numpy()
                begin = np.flatnonzero(group)
                before = np.cumsum(rows.body.map(len).to_numpy())
                full = begin[(begin > 0) & (before[begin - 1] >= SORTED_BYTES)] if len(begin) else begin
                end = full[0] if len(full) else begin[-1]
                if end == 0:
                    held = [rows]
                    break  # one group so far; it ends in a later batch
                yield from solve(rows[:end])
                held = [rows[end:].reset_index(drop=True)]
                size = int(held[0].body.map(len).sum())
        if held and sum(map(len, held)):
            yield from solve(pd.concat(held, ignore_index=True))

    return run


def _merge_range(width: int):
    """The windows of one anchor and range, from all shards: those that another shard holds, too."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        runs = [np.frombuffer(b, "<i8").reshape(5, -1) for b in group.body]
        keys = [r[0].view(np.uint64) for r in runs]
        out = []
        for k, mine in enumerate(keys):
            hit = np.zeros(len(mine), bool)
            for j, theirs in enumerate(keys):
                if j != k:
                    at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
                    hit |= theirs[at] == mine
            # A class that its own shard found repeated has marked its windows there.
            hit &= runs[k][4] == 0
            out.append(runs[k][1:4, hit])
        doc, h, start = np.concatenate(out, axis=1)
        order = np.lexsort((start, h, doc))
        doc, h, start = doc[order], h[order], start[order]
        cuts = np.flatnonzero(np.append(True, (np.diff(start) != 1) | (np.diff(doc) != 0) | (np.diff(h) != 0))) if len(start) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(start))[: len(cuts)] - 1
        return pd.DataFrame({"doc_id": doc[cuts], "h": h[cuts], "start": start[cuts], "stop": start[ends] + width})

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to the counts and the hash of what is left."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        spans = batch.column("spans")
        n_bytes, removed, count, digests = np.diff(offsets), [], [], []
        for k in range(batch.num_rows):
            raw = data[offsets[k] : offsets[k + 1]]
            gone = 0
            runs = 0
            kept = hashlib.sha256()
            at = 0
            for s in spans[k].as_py() or ():
                start, stop = max(s["start"], at), s["stop"]
                if s["start"] > at or (runs == 0 and s["start"] >= at):
                    kept.update(raw[at : s["start"]])
                    runs += 1
                if stop > start:
                    gone += stop - start
                    at = stop
            kept.update(raw[at:])
            removed.append(gone)
            count.append(runs)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_bytes.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, h, spans): for each text, by id and hash, the sorted spans of bytes to remove; they may overlap.

    A null doc_id is kept as the smallest long; rows that have that one share the spans of equal texts.
    Texts shorter than ``width`` bytes have no spans.
    """
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs).drop("id").where(F.octet_length("text") >= width)
    path = fresh_path(spark, "anchors")
    keyed.mapInArrow(_occurrences(width), "doc_id long, h long, a long, c long, first long, n int").write.parquet(path)
    found = spark.read.parquet(path)
    # One occurrence stands for a context: that with the smallest hash. Nothing is grouped by context after the
    # join below, and both of its sides are read from disk, so Spark can split a context that very many documents hold.
    found = found.withColumn("o", F.xxhash64("doc_id", "h", "first"))
    contexts = found.groupBy("a", "c").agg(F.count("*").alias("times"), F.min("o").alias("least"))
    of_anchor = contexts.groupBy("a").agg(F.count("*").alias("kinds"), F.sum("times").alias("total"), F.min("times").alias("rarest")).where("total > 1")
    contexts = cut(contexts.join(of_anchor, "a").select("a", "c", "times", "least", "kinds", "rarest"))
    release(spark)
    stop = F.col("first") + F.col("n") + (width - 1)
    fetched = F.struct("a", "c", "first", "n", "times", F.ceil(F.col("kinds") / SHARD_CONTEXTS).cast("int").alias("salts"))
    of_doc = found.join(contexts, ["a", "c"]).groupBy("doc_id", "h").agg(
        F.collect_set(F.when(F.col("times") > 1, F.struct(F.col("first").alias("start"), stop.alias("stop")))).alias("spans"),
        F.collect_list(F.when((F.col("kinds") > 1) & (F.col("rarest") == 1) & (F.col("o") == F.col("least")), fetched)).alias("asked"),
    )
    of_doc = cut(of_doc)
    whole, asked = of_doc.where(F.size("spans") > 0).select("doc_id", "h", "spans"), of_doc.where(F.size("asked") > 0).select("doc_id", "h", "asked")
    remove(spark, path)
    release(spark)
    bodies = keyed.join(asked, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).mapInArrow(_fetch(width), "doc_id long, h long, a long, c long, first long, n int, times long, salts int, body binary")
    bodies = bodies.withColumn("salt", F.pmod("c", "salts")).repartition(2 * n_parts, "a", "salt").sortWithinPartitions("a", "salt")
    shards = cut(bodies.mapInArrow(_sorted_shards(width), "doc_id long, h long, start long, stop long, a long, part long, body binary"))
    release(spark)
    spans = shards.where("part < 0").select("doc_id", "h", "start", "stop")
    merged = shards.where("part >= 0").repartition(2 * n_parts, "a", "part").groupBy("a", "part").applyInPandas(_merge_range(width), "doc_id long, h long, start long, stop long")
    spans = spans.unionByName(merged).groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "stop")).alias("more"))
    both = whole.join(spans, ["doc_id", "h"], "full")
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return both.select("doc_id", "h", F.sort_array(F.concat(F.coalesce("spans", empty), F.coalesce("more", empty))).alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text", F.col("doc_id").cast("long").alias("id"))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts count as empty. Rows that repeat a doc_id, or a doc_id and a text, are documents of their own.
    Columns besides doc_id and text are ignored.
    """
    spans = repeated_spans(docs, width)
    out = _keyed(docs).join(spans, ["doc_id", "h"], "left").select(F.col("id").alias("doc_id"), "text", "spans")
    return out.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


#: The definition itself: every window of 200 bytes, as hexadecimal text, counted; no anchors, no suffix arrays.
OP6_SQL = """with b as (select row_number() over () as rid, doc_id, encode(coalesce(text, '')) as t from documents),
h as (select rid, doc_id, octet_length(t) as n, lower(hex(t)) as x from b),
s as (select rid, unnest(range(0, greatest(n - 199, 0))) as i, x from h),
m as (select rid, i, md5_number(substr(x, 2 * i + 1, 400)) as k from s),
d as (select k from m group by k having count(*) > 1),
c as (select m.rid, m.i from m semi join d using (k)),
g as (select rid, i, case when i <= lag(i) over (partition by rid order by i) + 200 then 0 else 1 end as new from c),
q as (select rid, i, sum(new) over (partition by rid order by i) as run from g),
v as (select rid, run, min(i) as a, max(i) + 200 as z from q group by rid, run),
o as (select rid, a, z, coalesce(lag(z) over (partition by rid order by a), 0) as before, row_number() over (partition by rid order by a desc) as last from v),
y as (select h.rid, count(*) as n_spans, sum(z - a) as n_removed, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' order by a) || max(case when last = 1 then substr(x, 2 * z + 1) end) as rest
  from o join h using (rid) group by h.rid)
select h.doc_id, cast(n as bigint) as n_bytes, coalesce(cast(n_removed as bigint), 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, x))) as kept_sha256 from h left join y using (rid)"""
