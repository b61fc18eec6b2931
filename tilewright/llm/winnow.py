"""Content-defined anchors: positions that any two equal windows of bytes have in common."""

from __future__ import annotations

import numpy as np

from ._numpy_text import mix64

#: Bytes of an anchor's gram; a power of two.
GRAM = 32


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position, by doubling."""
    h = mix64(data.astype(np.uint64) + np.uint64(1))
    size, factor = 1, 0x9E3779B97F4A7C15
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:] if len(h) > size else h[:0]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF | 1
        size *= 2
    return mix64(h)


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows of ``window`` bytes within rows.

    A window's anchor is the gram in it with the smallest hash, the leftmost of several. Returns for each
    anchor its place in ``data``, its hash, and the first and last start of the windows whose anchor it is.
    """
    n, width = len(data), window - GRAM + 1
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty.astype(np.uint64), empty, empty
    h = gram_hashes(data)
    low, at = h, np.arange(len(h), dtype=np.int32)
    size = 1
    while size < width:  # the minimum over 1, 2, 4, ... grams, then over the rest
        step = min(size, width - size)
        left, right = low[:-step], low[step:]
        take = right < left
        at = np.where(take, at[step:], at[:-step])
        low = np.where(take, right, left)
        size += step
    start = np.arange(len(at))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[: len(at)] == row[window - 1 : window - 1 + len(at)]
    start, at = start[whole], at[whole].astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], h[at[first]], start[first], start[last]
