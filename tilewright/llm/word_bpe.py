"""The public word-level BPE tokenizer, run over batches in numpy.

The ids equal those of ``tokenizers`` for the same file. Texts of ASCII and Latin-1 letters take the
batch path: classes of bytes give the pieces of the pre-tokenizer, each distinct piece of a batch is
merged once (one array pass for each merge step over all pieces), and ids are gathered from there.
Other texts, and those that hold a special token's brackets, go through the library itself.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

import numpy as np

from ._numpy_text import distinct, hash_spans, ranges

LETTER, NUMBER, OTHER = 1, 2, 3
#: Pieces of more bytes than this go to the library.
LONG = 48
_NONE = np.int32(2**31 - 1)


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in plain else next(spare)) for b in range(256)}


def _class_of(char: str) -> int:
    if char.isspace() and ord(char) not in range(0x1C, 0x20):
        return 0
    kind = unicodedata.category(char)[0]
    return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


class WordBPE:
    """``path``: the vocabulary's JSON file, readable wherever this runs."""

    #: So many pieces, the most frequent of the first batch, keep their ids in memory.
    STORED = 300_000
    store: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = _byte_symbols()
        self.inner = np.array([vocab[symbols[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[symbols[b] + end] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.uint32)
        right = np.array([vocab[b] for _, b in pairs], np.uint32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._index((left << np.uint32(16)) | right)
        classes = [_class_of(chr(b)) if b < 128 else OTHER for b in range(256)]
        self.classes = np.array(classes, np.uint8)
        self.two = np.zeros((2, 256), np.uint8)  # of the character with lead byte C2 or C3
        for lead in (0, 1):
            for b in range(128, 192):
                self.two[lead, b] = _class_of(chr(0x80 + 64 * lead + b - 128))

    def _index(self, keys: np.ndarray) -> None:
        """Open addressing: a table from pair to rank, 5 % full."""
        self.bits = 20
        self.keys = np.full(1 << self.bits, 0xFFFFFFFF, np.uint32)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        rank = np.arange(len(keys), dtype=np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == 0xFFFFFFFF
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.ranks[at[won]] = rank[won]
            keys, rank, at = keys[~won], rank[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of ids; the largest int32 where there is no merge."""
        keys = (a.astype(np.uint32) << np.uint32(16)) | b.astype(np.uint32)
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], _NONE)
        miss = np.flatnonzero((found != keys) & (found != 0xFFFFFFFF))
        while len(miss):
            at[miss] = (at[miss] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[miss]]
            hit = found == keys[miss]
            out[miss[hit]] = self.ranks[at[miss[hit]]]
            miss = miss[~hit & (found != 0xFFFFFFFF)]
        return out

    def _merge(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of equal size, one a row: merges the lowest-ranked pair, leftmost first, until none is left.

        Returns the ids (rows padded on the right) and the number of ids in each row.
        """
        n, width = ids.shape
        size = np.full(n, width, np.int64)
        if width == 1:
            return ids, size
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        live = np.arange(n)
        done = ids.copy()
        cols = np.arange(width, dtype=np.int16)
        while len(live):
            best = ranks.argmin(1).astype(np.int16)
            low = ranks[np.arange(len(live)), best]
            go = low != _NONE
            if not go.all():
                done[live[~go]] = ids[~go]
                live, ids, ranks, best, low = live[go], ids[go], ranks[go], best[go], low[go]
                if not len(live):
                    break
            rows = np.arange(len(live))
            ids[rows, best] = self.made[low]
            behind = cols[:-1] > best[:, None]
            np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=behind)
            np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=behind[:, 1:])
            ranks[:, -1] = _NONE
            size[live] -= 1
            count = size[live]
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < count - 1)
            ranks[left, best[left] - 1] = self.rank(ids[left, best[left] - 1], ids[left, best[left]])
            ranks[right, best[right]] = self.rank(ids[right, best[right]], ids[right, best[right] + 1])
        return done, size

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, and the pieces' starts and ends."""
        data = data.copy()
        data[(data >= 65) & (data <= 90)] += 32
        n = len(data)
        kind = self.classes[data]
        lead = np.flatnonzero((data == 0xC2) | (data == 0xC3))
        if len(lead):
            after = data[lead + 1]
            capital = (data[lead] == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
            data[lead[capital] + 1] += 0x20
            kind[lead] = kind[lead + 1] = self.two[data[lead] - 0xC2, data[lead + 1]]
        border = np.zeros(n + 3, bool)
        border[offsets] = True
        border[n:] = True
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        start = (kind != 0) & (change | (kind == NUMBER) | border[:n])
        start[(data & 0xC0) == 0x80] = False
        quote = np.flatnonzero(start & (data == 0x27))
        quote = quote[~border[quote + 1]]
        if len(quote):
            one, two = data[quote + 1], np.where(border[quote + 2], 0, data[np.minimum(quote + 2, n - 1)])
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108))
            for at, k in ((quote[short], 1), (quote[long & ~short], 2)):
                start[at + 1] = False
                nxt = at + 1 + k
                nxt = nxt[~border[nxt]]
                start[nxt[kind[nxt] == LETTER]] = True
        ends = kind != 0
        ends[:-1] &= (kind[1:] == 0) | start[1:] | border[1:n]
        return data, np.flatnonzero(start), np.flatnonzero(ends) + 1

    def _ids_of_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, and each piece's place and number of ids in them."""
        size = ends - starts
        first, count, flat, used = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), [], 0
        if not len(starts):
            return np.zeros(0, np.int32), first, count
        order = np.argsort(size, kind="stable")
        widths, at = np.unique(size[order], return_index=True)
        for width, group in zip(widths.tolist(), np.split(order, at[1:]), strict=True):
            if width > LONG:
                for k in group.tolist():
                    ids = np.array(self.library.encode(data[starts[k] : ends[k]].tobytes().decode(), add_special_tokens=False).ids, np.int32)
                    first[k], count[k] = used, len(ids)
                    flat.append(ids)
                    used += len(ids)
                continue
            block = data[starts[group][:, None] + np.arange(width)]
            ids = self.inner[block]
            ids[:, -1] = self.final[block[:, -1]]
            ids, n = self._merge(ids)
            first[group], count[group] = used + np.cumsum(n) - n, n
            flat.append(ids[np.arange(width) < n[:, None]])
            used += int(n.sum())
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), first, count

    def _known(self, keys: np.ndarray, times: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_ids_of_pieces``, but only for pieces that aren't among the frequent ones of the first batch."""
        if self.store is None:
            flat, first, count = self._ids_of_pieces(data, starts, ends)
            often = np.argsort(-times, kind="stable")[: self.STORED]
            often = often[np.argsort(keys[often])]
            if len(often) >= 1000:
                self.store = keys[often], flat[ranges(first[often], count[often])], np.cumsum(count[often]) - count[often], count[often]
            return flat, first, count
        have, flat, begin, n = self.store
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        hit = have[at] == keys
        first, count = begin[at], n[at]
        miss = np.flatnonzero(~hit)
        more, first[miss], count[miss] = self._ids_of_pieces(data, starts[miss], ends[miss])
        first[miss] += len(flat)
        return np.concatenate([flat, more]), first, count

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of a text column given as bytes and offsets (see ``text_bytes``)."""
        n = len(offsets) - 1
        odd = np.flatnonzero((data >= 0xC4) | (data == 0x7C))  # beyond Latin-1, or a special token's bar
        rare = np.zeros(n, bool)
        rare[np.searchsorted(offsets, odd, "right") - 1] = True
        out: list[np.ndarray | None] = [None] * n
        for k in np.flatnonzero(rare).tolist():
            raw = data[offsets[k] : offsets[k + 1]]
            if raw.max() < 0xC4 and b"<|" not in (text := raw.tobytes()):
                rare[k] = False
            else:
                text = raw.tobytes()
                out[k] = np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.int32)
        kept = np.flatnonzero(~rare)
        if len(kept) < n:
            size = np.diff(offsets)[kept]
            data, offsets = data[ranges(offsets[kept], size)], np.concatenate([[0], np.cumsum(size)])
        data, starts, ends = self._pieces(data, offsets)
        if len(starts):
            keys = hash_spans(data, starts, ends)
            one, number = distinct(keys)
            flat, first, count = self._known(keys[one], np.bincount(number), data, starts[one], ends[one])
            size = count[number]
            ids = flat[ranges(first[number], size)]
            total = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, offsets)]
        else:
            ids, total = np.zeros(0, np.int32), np.zeros(len(kept) + 1, np.int64)
        for i, k in enumerate(kept.tolist()):
            out[k] = ids[total[i] : total[i + 1]]
        return out


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    """One tokenizer for each file and Python worker."""
    return WordBPE(path)


def public_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


if sys.byteorder != "little":  # pragma: no cover
    raise ImportError("word hashes read bytes in little-endian order")
