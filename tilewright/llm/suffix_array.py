"""Suffix arrays by Larsson-Sadakane refinement and common prefixes by Kasai's method, in numpy."""

from __future__ import annotations

import numpy as np

#: Positions that Kasai's method walks side by side.
LANES = 4096


def _words(text: np.ndarray, pad: int) -> np.ndarray:
    """The 8 bytes from each position, little-endian, zeros behind the end."""
    padded = np.concatenate([text, np.zeros(pad + 8, np.uint8)])
    return np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` bytes at least.

    Suffixes are sorted by 8 bytes at first. In each round, the groups that aren't single yet are sorted by
    the rank of the suffix that begins where the sorted prefix ends, which doubles the prefix.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    key = _words(text, 0)[:n].byteswap()
    sa = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[sa[1:]] != key[sa[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    size = 8
    open_at = np.flatnonzero(~(new & np.append(new[1:], True)))
    while size < depth and len(open_at):
        pos = sa[open_at]
        key = rank[pos] * (n + 1) + rank[np.minimum(pos + size, n)] + 1
        order = np.argsort(key, kind="stable")
        pos, key = pos[order], key[order]
        sa[open_at] = pos
        new = np.ones(len(pos), bool)
        new[1:] = key[1:] != key[:-1]
        rank[pos] = np.maximum.accumulate(np.where(new, open_at, 0))
        open_at = open_at[~(new & np.append(new[1:], True))]
        size *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For each place in ``sa``: how many first bytes its suffix shares with the one before, ``cap`` at most.

    Kasai: from one position of the text to the next a common prefix shrinks by one byte at most, as long as
    the two suffixes keep their order. Suffixes that tie as far as ``sa`` is sorted may change it; from there
    on nothing is known. The text is cut into lanes, and all lanes take a step at once.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    word = _words(text, cap + 16)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    per = -(-n // LANES)
    lane = np.arange(0, n, per)
    k = np.zeros(len(lane), np.int64)
    for step in range(per):
        i = lane + step
        if i[-1] >= n or (step and len(i) > 1 and i[-1] >= n):
            lane, k, i = lane[:-1], k[:-1], i[:-1]
        q = before[i]
        k[q < 0] = 0
        live = np.flatnonzero((q >= 0) & (k < cap))
        while len(live):
            differ = word[i[live] + k[live]] ^ word[q[live] + k[live]]
            same = differ == 0
            apart = live[~same]
            low = differ[~same]
            k[apart] += (np.log2((low & (~low + np.uint64(1))).astype(np.float64)) // 8).astype(np.int64)
            live = live[same]
            k[live] += 8
            live = live[k[live] < cap]
        np.minimum(k, cap, out=k)
        out[rank[i]] = np.where(q < 0, 0, k)
        tied = np.flatnonzero(k == cap)
        k = np.maximum(k - 1, 0)
        k[tied[rank[q[tied] + 1] > rank[i[tied] + 1]]] = 0
    return out
