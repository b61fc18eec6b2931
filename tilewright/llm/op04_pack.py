"""Hierarchical residual packing of tokenised documents into sequences.

Each input partition tokenises its documents, cuts those that are too long, packs the pieces by best fit in
order of falling length, and emits the bins that are full but for ``capacity // SLACK`` tokens. The pieces of
the others go on as items: a tree over the partitions merges ``FAN`` nodes at a time, packs what their
underfull bins hold anew, and again emits what is nearly full; the root emits all. Passing on an underfull bin's
pieces rather than the bin lets long pieces of one partition meet short ones of another.

Best fit needs no more of the pieces than how many there are of each length: pieces of equal length fill runs
of bins with equal room, many at a time. So a node of the tree gets, of each child, a histogram with at most
``capacity`` lengths, however many pieces are left, and gives ranges of pieces of one length: those that it
has placed, and those that go on. These ranges are then composed from the root down, and each piece finds its
place by its partition, its length and its number there.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._numpy_text import row_chunks, text_bytes
from ._shared import cut, table, texts
from .word_bpe import public_path, word_bpe

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_NAMES = [c.split()[0] for c in PIECE.split(", ")]
#: A bin counts as nearly full with room for a SLACK-th of its capacity at most.
SLACK = 128
#: Nodes of the tree that are merged into one.
FAN = 16


class Plan(NamedTuple):
    """Where pieces go, numbered from the longest to the shortest, those of equal length in a row."""

    #: Falling; the number of each length's first piece.
    lengths: np.ndarray
    starts: np.ndarray
    #: For runs of pieces: the number of the first, how many go into each bin, the first bin, and the content of these bins before.
    first: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    before: np.ndarray
    #: Bins with room left, as ranges [low, high) in order, and their room.
    low: np.ndarray
    high: np.ndarray
    room: np.ndarray

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces, by length and number among those of equal length."""
        number = self.starts[np.searchsorted(-self.lengths, -lengths)] + ranks
        run = np.searchsorted(self.first, number, "right") - 1
        nth, within = np.divmod(number - self.first[run], self.each[run])
        return self.bin[run] + nth, self.before[run] + within * lengths


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing of ``counts`` pieces of each of the different ``lengths``, a run of bins with equal room at a time.

    A piece goes into the fullest bin that has room for it; of bins with equal room into the oldest.
    """
    order = np.argsort(-lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    rooms: list[int] = []  # sorted
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room to runs of bins [low, high), the last is the oldest
    out: list[tuple[int, int, int, int]] = []
    number = n_bins = 0

    def leave(room: int, low: int, high: int) -> None:
        if room and low < high:
            if not runs[room]:
                insort(rooms, room)
            insort(runs[room], (low, high), key=lambda x: -x[0])

    for length, left in zip(lengths.tolist(), counts.tolist(), strict=True):
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                low, high = runs[room].pop()
                if not runs[room]:
                    del rooms[at]
            else:
                room, low = capacity, n_bins
                n_bins = high = low + -(-left // (capacity // length))
            each = room // length
            taken = min(left, each * (high - low))
            out.append((number, each, low, capacity - room))
            full, more = divmod(taken, each)
            leave(room - each * length, low, low + full)
            if more:
                leave(room - more * length, low + full, low + full + 1)
            leave(room, low + full + (more > 0), high)
            number, left = number + taken, left - taken
    left_over = sorted((low, high, room) for room, some in runs.items() for low, high in some)
    return Plan(lengths, np.cumsum(counts) - counts, *np.array(out, np.int64).reshape(-1, 4).T.copy(), *np.array(left_over, np.int64).reshape(-1, 3).T.copy())


def ranked(sizes: np.ndarray) -> np.ndarray:
    """Each item's number among those of equal size."""
    order = np.argsort(sizes, kind="stable")
    ranks = np.empty(len(sizes), np.int64)
    ranks[order] = np.arange(len(sizes)) - np.searchsorted(sizes[order], sizes[order])
    return ranks


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and place in it, and each bin's content.

    Ties: items of equal size keep their order; of bins with equal room the oldest is taken.
    """
    bins, places = plan(*np.unique(sizes, return_counts=True), capacity).places(sizes, ranked(sizes))
    return bins, places, np.bincount(bins, sizes).astype(np.int64)


def _segments(where: Plan, total: int, slack: int) -> list[tuple[int, int, int, int, int, int]]:
    """Pieces as ranges (first number, end, bin, each, before, is_open): whole runs, cut where open bins begin and end.

    Open are bins with more room than ``slack``.
    """
    wide = where.room > slack
    low, high = where.low[wide].tolist(), where.high[wide].tolist()
    ends = np.append(where.first[1:], total).tolist()
    out = []
    for first, end, each, bin_, before in zip(where.first.tolist(), ends, where.each.tolist(), where.bin.tolist(), where.before.tolist(), strict=True):
        at, last = bin_, bin_ + -(-(end - first) // each)
        k = bisect_left(high, at + 1)
        while at < last:
            open_ = k < len(low) and low[k] <= at
            stop = min(last, high[k] if open_ else low[k] if k < len(low) else last)
            out.append((first + (at - bin_) * each, min(end, first + (stop - bin_) * each), at, each, before, int(open_)))
            k += open_ and stop == high[k]
            at = stop
    return out


def pieces_of(docs: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, bin, offset, rank): the pieces, packed within each partition.

    Those of underfull bins have the bin -1, and a number among those of equal length.
    """
    path = None if vocabulary == "public" else vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_bpe(path or public_path())
        cols: list[list] = [[], [], [], [], []]
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids_of = batch.column("doc_id").to_pylist()
            for a, b in row_chunks(offsets, 8 << 20):
                encoded = tokenizer.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for doc_id, ids in zip(ids_of[a:b], encoded, strict=True):
                    ids = np.append(ids, end_id).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        for col, v in zip(cols, (doc_id, k, start, len(part), zlib.crc32(part)), strict=True):
                            col.append(v)
        sizes = np.array(cols[3], np.int64)
        bins, offsets, filled = best_fit(sizes, capacity)
        underfull = (filled < capacity - capacity // SLACK)[bins]
        rank = np.zeros(len(sizes), np.int64)
        rank[underfull] = ranked(sizes[underfull])
        arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
        arrays += [pa.array(np.full(len(sizes), TaskContext.get().partitionId(), np.int64)), pa.array(np.where(underfull, -1, bins)), pa.array(offsets), pa.array(rank)]
        yield pa.RecordBatch.from_arrays(arrays, [*_NAMES, "part", "bin", "offset", "rank"])

    return docs.mapInArrow(run, f"{PIECE}, part long, bin long, offset long, rank long")


#: A node's pieces of one length, by child: those from number ``first`` on, ``n`` of them. Placed ones: the k-th goes into bin
#: ``bin`` + q div ``each`` at offset ``before`` + q mod ``each`` * length, q = ``shift`` + k. Those that go on: the first one's number at the node is ``shift``.
_MOVES = "node long, child long, length long, first long, n long, is_open int, bin long, each long, before long, shift long"


def _merged(capacity: int, slack: int):
    """(node, child, length, n) of a node to its moves."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "child"], ascending=[False, True])
        length, n = group["length"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        lengths, at = np.unique(-length, return_index=True)
        where = plan(-lengths, np.add.reduceat(n, at), capacity)
        total = int(n.sum())
        seg = np.array(_segments(where, total, slack), np.int64)
        # Pieces are numbered through lengths and children, so ranges of children and of places are cut at the bounds of both.
        begin = np.cumsum(n) - n
        cuts = np.union1d(begin, seg[:, 0])
        row, s = np.searchsorted(begin, cuts, "right") - 1, np.searchsorted(seg[:, 0], cuts, "right") - 1
        count = np.append(cuts[1:], total) - cuts
        seg = seg[s]
        is_open = seg[:, 5] == 1
        shift = cuts - seg[:, 0]
        first_of = np.searchsorted(-length, -length[row], "left")
        went = np.cumsum(np.where(is_open, count, 0)) - np.where(is_open, count, 0)
        base = went[np.searchsorted(cuts, begin[first_of])]
        shift = np.where(is_open, went - base, shift)
        return pd.DataFrame({
            "node": group["node"].iloc[0], "child": group["child"].to_numpy()[row], "length": length[row], "first": cuts - begin[row], "n": count,
            "is_open": is_open.astype(np.int32), "bin": seg[:, 2], "each": seg[:, 3], "before": seg[:, 4], "shift": shift,
        })

    return run


def _composed(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """Moves of one level's nodes, whose open ranges take the places that ``outer``, the resolved moves of the level above, gives them."""
    done = inner.where("is_open = 0").select("child", "length", "first", "n", F.col("id").alias("id"), "bin", "each", "before", "shift")
    a, b = inner.where("is_open = 1").alias("a"), outer.alias("b")
    meet = (F.col("a.node") == F.col("b.child")) & (F.col("a.length") == F.col("b.length")) & (F.col("a.shift") < F.col("b.first") + F.col("b.n")) & (F.col("b.first") < F.col("a.shift") + F.col("a.n"))
    low, high = F.greatest("a.shift", "b.first"), F.least(F.col("a.shift") + F.col("a.n"), F.col("b.first") + F.col("b.n"))
    moved = a.join(b, meet).select(
        "a.child", "a.length", (F.col("a.first") + low - F.col("a.shift")).alias("first"), (high - low).alias("n"), "b.id", "b.bin", "b.each", "b.before", (F.col("b.shift") + low - F.col("b.first")).alias("shift")
    )
    return done.unionByName(moved)


def pack(docs: DataFrame, capacity: int = 4096, vocabulary: str = "public", end_id: int = 1) -> DataFrame:
    """Packs every document of ``docs`` (doc_id, text; other columns are ignored) into sequences.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    A null or empty text is one piece that holds the end id alone. Rows that repeat a doc_id are
    documents of their own; a null doc_id stays null. An empty table gives no rows.
    ``vocabulary``: the tokenizer's file, or "public" for the installed public one, found on each executor.
    """
    if capacity < 1 or capacity >= 1 << 24:
        raise ValueError("capacity must be positive and below 2**24")
    pieces = cut(pieces_of(texts(docs), capacity, vocabulary, end_id))
    left = pieces.where("bin < 0").groupBy(F.col("part").alias("node"), "length").agg(F.count("*").alias("n"))
    last = pieces.agg(F.max("part")).first()[0] or 0
    levels: list[DataFrame] = []
    while not levels or last:
        last //= FAN
        items = left.select(F.floor(F.col("node") / FAN).cast("long").alias("node"), F.col("node").alias("child"), "length", "n")
        moves = items.groupBy("node").applyInPandas(_merged(capacity, capacity // SLACK if last else capacity), _MOVES)
        levels.append(cut(moves.withColumn("id", _sequences(len(levels) + 1, F.col("node")))))
        left = levels[-1].where("is_open = 1").groupBy("node", "length").agg(F.sum("n").alias("n"))
    places = levels[-1].drop("node", "is_open")
    for level in reversed(levels[:-1]):
        places = cut(_composed(level, places))
    whole = pieces.where("bin >= 0").select(*_NAMES, (_sequences(0, F.col("part")) + F.col("bin")).alias("sequence_id"), "offset")
    a, b = pieces.where("bin < 0").alias("a"), places.alias("b")
    mine = (F.col("a.part") == F.col("b.child")) & (F.col("a.length") == F.col("b.length")) & F.col("a.rank").between(F.col("b.first"), F.col("b.first") + F.col("b.n") - 1)
    q = F.col("b.shift") + F.col("a.rank") - F.col("b.first")
    nth = F.floor(q / F.col("b.each")).cast("long")
    rest = a.join(b, mine).select(*[f"a.{c}" for c in _NAMES], (F.col("b.id") + F.col("b.bin") + nth).alias("sequence_id"), (F.col("b.before") + (q - nth * F.col("b.each")) * F.col("a.length")).alias("offset"))
    return whole.unionByName(rest)


def _sequences(level: int, node: Column) -> Column:
    """The first sequence number of a node: 2**34 for each of 2**24 nodes, and 2**58 for each level."""
    return F.lit(level << 58) + node * F.lit(1 << 34)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
