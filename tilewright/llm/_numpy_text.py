"""Byte-level text work in numpy: words, word hashes and chunks of Arrow string columns.

Everything here sees a column of texts as one run of UTF-8 bytes plus offsets, so that a batch of
documents costs a fixed number of array passes and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that end a word: the space and \t \n \v \f \r.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on uint64 (changes its argument)."""
    x ^= x >> np.uint64(33)
    x *= _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = max(at + 1, min(to, n))
        yield at, to
        at = to


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z; other bytes stay."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


def words(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that aren't white, within rows.

    Returns their starts, their ends, and for each row the number of words before it (n + 1 values).
    """
    ink = ~white[data]
    n = len(data)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    first, last = ink.copy(), ink.copy()
    if n:
        first[1:] &= ~ink[:-1] | border[1:n]
        last[:-1] &= ~ink[1:] | border[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans: equal spans get equal values in any batch."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))
    size = (ends - starts).astype(np.int64)
    out = mix64(size.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x51) & 0xFFFFFFFFFFFFFFFF))
    at = 0
    live = None
    while True:
        s = starts if live is None else starts[live]
        left = (size if live is None else size[live]) - at
        w = view[s + at].astype(np.uint64)
        short = left < 8
        w[short] &= (np.uint64(1) << (np.maximum(left[short], 0) * 8).astype(np.uint64)) - np.uint64(1)
        if live is None:
            out = mix64(out ^ w)
        else:
            out[live] = mix64(out[live] ^ w)
        at += 8
        live = np.flatnonzero(size > at) if live is None else live[size[live] > at]
        if len(live) == 0:
            return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one occurrence of each distinct key, and each key's number among them."""
    inverse = pa.array(keys).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    one = np.zeros(int(inverse.max()) + 1 if len(inverse) else 0, np.int64)
    one[inverse] = np.arange(len(inverse))
    return one, inverse


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of starts[i] .. starts[i] + sizes[i] - 1."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)
