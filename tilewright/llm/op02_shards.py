"""Training-order materialisation: sequences of token ids in fixed-stride binary shards, in keyed random order.

The documents of each input split are one stream of ids, cut into sequences of ``length``; a split's last
sequence is padded. Sequences are numbered through all splits, and a keyed Feistel permutation with
cycle-walking gives each number a global slot in 0 .. n - 1: the order of training, known without sorting.
Slots are dealt out by ranges, and each range is written in order as one file of records of equal size. So
slot s is in file s // per_shard, from byte (s % per_shard) * stride on, and reading can resume anywhere.

Files are written and read by Spark's own access to stores, so any store that Spark writes to will do, and a
shard appears when the job that writes it commits. A record is its ids and one byte that ends it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._numpy_text import mix64, row_chunks, text_bytes
from ._shared import cut, fresh_path, release, table, texts
from .word_bpe import public_path, word_bpe

LENGTH, PER_SHARD = 1024, 8192
ROUNDS = 8
#: Bytes of shards that one task writes, if not one shard is larger.
TASK_BYTES = 32 << 20


def feistel(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of ``numbers``, each below ``n``: a permutation of 0 .. n - 1 that ``key`` selects.

    A balanced Feistel network permutes the next larger even power of two; what falls beyond ``n`` goes
    through it again until it doesn't.
    """
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    low, bits = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix64(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & low
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & low)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[tuple[int, np.ndarray]]:
    tokenizer = word_bpe(public_path() if vocabulary == "public" else vocabulary)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        ids_of = batch.column("doc_id").to_pylist()
        for a, b in row_chunks(offsets, 8 << 20):
            encoded = tokenizer.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for doc_id, ids in zip(ids_of[a:b], encoded, strict=True):
                ids = np.append(ids, end_id)
                if ids.max() > 0xFFFF:
                    raise ValueError("ids beyond 65535 don't fit the shards' 16 bits")
                yield doc_id, ids.astype("<u2")


def _streamed(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, length: int) -> Iterator[tuple[tuple, tuple, int, int, np.ndarray]]:
    """For each batch of a split: its documents' ids and numbers of tokens, the tokens before them, and the sequences
    that end in it: the first one's number and all their ids. At last the padded one, where tokens are left."""
    left, before = np.zeros(0, "<u2"), 0
    for batch in batches:
        found = list(_encoded(iter([batch]), vocabulary, end_id))
        counts = tuple(len(ids) for _, ids in found)
        ids = np.concatenate([left, *[ids for _, ids in found]])
        whole = len(ids) // length * length
        yield tuple(d for d, _ in found), counts, before, before // length, ids[:whole]
        left, before = ids[whole:], before + sum(counts)
    if len(left):
        yield (), (), before, before // length, np.append(left, np.zeros(length - len(left), "<u2"))


_COUNTED = "part int, before long, n long, doc_ids array<long>, counts array<long>, number long, crc array<long>"


def _counted(vocabulary: str, end_id: int, length: int):
    """Texts to a row for each batch: what ``_streamed`` gives, with the sequences' checksums instead of them."""
    lists = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for doc_ids, counts, before, number, ids in _streamed(batches, vocabulary, end_id, length):
            crc = [zlib.crc32(ids[k : k + length]) for k in range(0, len(ids), length)]
            row = ([part], pa.int32()), ([before], pa.int64()), ([sum(counts)], pa.int64()), ([doc_ids], lists), ([counts], lists), ([number], pa.int64()), ([crc], lists)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in row], [c.split()[0] for c in _COUNTED.split(", ")])

    return run


def _pieces(splits, length: int, total: int, key: int):
    """Rows of ``_counted`` to rows of slots: with offset, doc_id, start and length of a document's piece, or with the checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["slot", "offset", "doc_id", "start", "length", "crc"]
        for batch in batches:
            for k in range(batch.num_rows):
                ids, n, crc = (batch.column(c)[k].values for c in ("doc_ids", "counts", "crc"))
                n, first = np.asarray(n), splits.value[0][batch.column("part")[k].as_py()]
                end = batch.column("before")[k].as_py() + np.cumsum(n)
                begin = end - n
                many = (end - 1) // length - begin // length + 1
                doc = np.repeat(np.arange(len(n)), many)
                number = np.repeat(begin // length, many) + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                low, high = np.maximum(begin[doc], number * length), np.minimum(end[doc], (number + 1) * length)
                columns = [pa.array((low - number * length).astype(np.int32)), ids.take(pa.array(doc)), pa.array(low - begin[doc]), pa.array((high - low).astype(np.int32)), pa.nulls(len(doc), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(feistel(number + first, total, key)), *columns], names)
                slots = feistel(np.arange(len(crc)) + batch.column("number")[k].as_py() + first, total, key)
                none = [pa.nulls(len(crc), c.type) for c in columns[:4]]
                yield pa.RecordBatch.from_arrays([pa.array(slots), *none, crc], names)

    return run


def _sequences(vocabulary: str, end_id: int, length: int, splits, total: int, key: int, per_shard: int):
    """Texts to (slot, shard, ids). ``splits``: a broadcast of each split's first number and of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first, expected = (int(v[part]) if part < len(v) else 0 for v in splits.value)  # splits without rows may come last
        seen = 0
        for _, counts, _, number, ids in _streamed(batches, vocabulary, end_id, length):
            seen += sum(counts)
            slots = feistel(np.arange(len(ids) // length) + number + first, total, key)
            for k in range(0, len(slots), 2048):
                some = slots[k : k + 2048]
                raw = [ids[i * length : (i + 1) * length].tobytes() for i in range(k, k + len(some))]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array((some // per_shard).astype(np.int32)), pa.array(raw, pa.binary())], ["slot", "shard", "ids"])
        if seen != expected:
            raise RuntimeError(f"a split held {expected} tokens when they were counted, and {seen} now: the input isn't stable, write it to a table first")

    return run


def shard_dir(out_dir: str, shard: int) -> str:
    """The folder of a shard; it holds one file."""
    return f"{out_dir}/shard={shard}"


def materialise(docs: DataFrame, out_dir: str, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = 1, vocabulary: str = "public", end_id: int = 1) -> DataFrame:
    """Writes the shards to ``out_dir`` (any path that Spark can write) and a manifest beside them, and returns their index.

    The index has a row for each sequence: slot, shard, byte, n_tokens (the rest is padding, id 0), ids_crc32
    (of the record's ids) and pieces: doc_id, start (that document's ids before) and length, in order.
    ``docs`` must be a stable table, such as files: it is read twice, and a split that changed in between
    stops the job. ``out_dir`` must be new. A null or empty text is its end id alone; rows that repeat a doc_id are documents of
    their own; an empty table gives a manifest and no shard. Ids beyond 65535 raise ``ValueError``.

    The driver gets a number for each input split, and sends two for each to the tasks; a task writes the
    shards of a range of slots, about ``TASK_BYTES`` of them or one shard.
    """
    spark = docs.sparkSession
    source = texts(docs)
    counts = cut(source.mapInArrow(_counted(vocabulary, end_id, length), _COUNTED))
    of_split = counts.groupBy("part").agg(F.sum("n").alias("n")).toPandas()
    tokens = np.zeros(int(of_split["part"].max()) + 1 if len(of_split) else 1, np.int64)
    tokens[of_split["part"].to_numpy(np.int64)] = of_split["n"].to_numpy(np.int64)
    sequences = -(-tokens // length)
    total, stride = int(sequences.sum()), 2 * length + 1
    splits = spark.sparkContext.broadcast((np.cumsum(sequences) - sequences, tokens))
    spark.createDataFrame([(total, length, stride, per_shard, key, "<u2")], _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/_manifest")
    shards = -(-total // per_shard)
    if shards:
        rows = source.mapInArrow(_sequences(vocabulary, end_id, length, splits, total, key, per_shard), "slot long, shard int, ids binary")
        of_task = max(1, TASK_BYTES // (per_shard * stride))
        rows = rows.repartitionById(-(-shards // of_task), F.floor(F.col("shard") / of_task).cast("int")).sortWithinPartitions("shard", "slot")
        records = rows.select(F.col("ids").cast("string").alias("record"), "shard")
        records.write.mode("append").option("lineSep", "\n").option("compression", "none").partitionBy("shard").text(out_dir)
        release(spark)
    found = counts.mapInArrow(_pieces(splits, length, total, key), "slot long, offset int, doc_id long, start long, length int, crc long")
    piece = F.when(F.col("offset").isNotNull(), F.struct("offset", "doc_id", "start", "length"))
    index = found.groupBy("slot").agg(F.sum("length").cast("int").alias("n_tokens"), F.max("crc").alias("ids_crc32"), F.sort_array(F.collect_list(piece)).alias("pieces"))
    index = index.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("int"))
    byte = (F.col("slot") % per_shard) * stride
    return cut(index.select("slot", "shard", byte.alias("byte"), "n_tokens", "ids_crc32", F.transform("pieces", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"))).alias("pieces")))


_MANIFEST = "sequences long, length int, stride int, per_shard int, key long, dtype string"


def read_slots(spark: SparkSession, out_dir: str, start: int = 0, n: int | None = None, block: int = 1024) -> Iterator[np.ndarray]:
    """Records from slot ``start`` on, in training order; each shard is read in sequence from where it's needed."""
    m = spark.read.parquet(f"{out_dir}/_manifest").first()
    stop = m.sequences if n is None else min(m.sequences, start + n)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while start < stop:
        shard, at = divmod(start, m.per_shard)
        here = min(stop - start, m.per_shard - at)
        folder = jvm.org.apache.hadoop.fs.Path(shard_dir(out_dir, shard))
        files = folder.getFileSystem(conf)
        (file,) = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")]
        stream = files.open(file)
        try:
            stream.seek(at * m.stride)
            for k in range(0, here, block):
                some = min(block, here - k)
                raw = np.frombuffer(bytes(jvm.org.apache.commons.io.IOUtils.readFully(stream, some * m.stride)), np.uint8).reshape(some, m.stride)
                yield from np.ascontiguousarray(raw[:, :-1]).view(m.dtype)
        finally:
            stream.close()
        start += here


def op2_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of the shards, one row for each document's piece of a sequence."""
    index = materialise(table(spark, sf_dir, "documents"), fresh_path(spark, "shards"))
    rows = index.select("slot", "shard", "byte", "n_tokens", "ids_crc32", F.posexplode("pieces").alias("piece", "p"))
    return rows.select("slot", "shard", "byte", "n_tokens", "ids_crc32", "piece", "p.doc_id", "p.start", F.col("p.length").cast("long").alias("length"))
