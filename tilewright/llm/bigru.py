"""A bidirectional gated recurrent network with attention pooling, in numpy: training and scoring.

Inputs are words. A word's vector holds a learned embedding of the word (of those the training sample
tells most about), the mean of learned embeddings of its character 4-grams, and how far the word and its
4-grams tell the classes apart in the training sample. Both directions read a window of ``WINDOW`` words;
attention pools their states to one logit. A text's logit is the largest of its windows, which overlap
by half and cover every word.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from ._numpy_text import distinct, hash_spans, lower_ascii, ranges, row_chunks, words

WINDOW, STRIDE = 32, 16
HIDDEN, ATTENTION = 8, 8
WORD_DIM, CHAR_DIM = 4, 6
GRAM_BITS, N_WORDS = 16, 4096
#: Bytes of texts that are scored at once, if not one text is longer.
CHUNK = 1 << 20
INPUT = WORD_DIM + CHAR_DIM + 2

#: White space and ASCII punctuation end a word here.
BREAK = np.zeros(256, dtype=bool)
BREAK[:128] = [not chr(b).isalnum() for b in range(128)]


@dataclass
class Words:
    """The words of some texts: each one's number among the distinct ones, and these' hashes and 4-grams."""

    at: np.ndarray  # first word of each text, n + 1 values
    number: np.ndarray
    keys: np.ndarray
    grams: np.ndarray  # flat buckets
    first: np.ndarray  # place of each distinct word's first 4-gram


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = lower_ascii(data)
    starts, ends, at = words(data, offsets, BREAK)
    keys = hash_spans(data, starts, ends)
    one, number = distinct(keys)
    s, size = starts[one], (ends - starts)[one]
    wide = np.maximum(size + 2, 4)  # with a mark before, and at least one behind
    first = np.cumsum(wide) - wide
    flat = np.full(int(wide.sum()) + 4, 3, np.uint8)
    flat[first] = 2
    flat[ranges(first + 1, size)] = data[ranges(s, size)]
    n = wide - 3
    view = np.ndarray((len(flat) - 3,), "<u4", buffer=flat, strides=(1,))
    grams = (view[ranges(first, n)] * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)
    return Words(at, number, keys[one], grams.astype(np.int64), np.cumsum(n) - n)


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of each window."""
    size = np.diff(at)
    n = np.where(size > 0, np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(size)), n)
    start = at[:-1][text] + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    return text, start, np.minimum(at[1:][text] - start, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


@dataclass
class Model:
    """``p``: the weights. ``keys``: sorted hashes of the words that have an embedding; number 0 is for all others."""

    p: dict[str, np.ndarray]
    keys: np.ndarray
    word_odds: np.ndarray
    gram_odds: np.ndarray
    shift: float = 0.0
    cache: dict = field(default_factory=dict)

    def word_numbers(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 1, 0)

    def inputs(self, w: Words) -> np.ndarray:
        """One row for each distinct word."""
        if not len(w.keys):
            return np.zeros((0, INPUT), np.float32)
        k = self.word_numbers(w.keys)
        count = np.diff(np.append(w.first, len(w.grams)))[:, None]
        chars = np.add.reduceat(self.p["chars"][w.grams], w.first) / count.astype(np.float32)
        best = np.maximum.reduceat(self.gram_odds[w.grams], w.first)
        return np.concatenate([self.p["words"][k], chars, self.word_odds[k][:, None], best[:, None]], 1).astype(np.float32)

    def _states(self, way: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (T, B, HIDDEN) from projected inputs (T, B, 3 HIDDEN)."""
        u, h = self.p["u" + way], np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        d = HIDDEN
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            g = h @ u
            zr = _sigmoid(x[t, :, : 2 * d] + g[:, : 2 * d])
            z, r = zr[:, :d], zr[:, d:]
            new = np.tanh(x[t, :, 2 * d :] + r * g[:, 2 * d :])
            if keep is not None:
                keep.append((t, h, z, r, new, g[:, 2 * d :]))
            h = (new + z * (h - new)) * mask[t][:, None]
            out[t] = h
        return out

    def _pool(self, states: np.ndarray, mask: np.ndarray):
        a = np.tanh(states @ self.p["wa"] + self.p["ba"])
        s = a @ self.p["va"]
        e = np.exp(s - s.max(0)) * mask
        share = e / e.sum(0)
        pooled = np.einsum("tb,tbh->bh", share, states)
        return a, share, pooled, pooled @ self.p["wo"] + self.p["bo"]

    def logits(self, number: np.ndarray, x_of: dict[str, np.ndarray], mask: np.ndarray) -> np.ndarray:
        """``number`` (T, B): distinct words; ``x_of``: their projected inputs in each direction."""
        states = np.concatenate([self._states(way, x_of[way][number], mask) for way in "fb"], 2)
        return self._pool(states, mask)[3][:, 0]

    def of_texts(self, data: np.ndarray, offsets: np.ndarray, block: int = 2048) -> np.ndarray:
        """The largest window logit of each text; -inf for texts without words."""
        out = np.full(len(offsets) - 1, -np.inf, np.float64)
        for a, b in row_chunks(offsets, CHUNK):
            w = read_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if not len(w.number):
                continue
            x = self.inputs(w)
            x_of = {way: x @ self.p["w" + way] + self.p["b" + way] for way in "fb"}
            text, start, size = windows(w.at)
            best = np.empty(len(text), np.float32)
            for k in range(0, len(text), block):
                step = np.arange(WINDOW)[:, None]
                mask = (step < size[k : k + block]).astype(np.float32)
                place = start[k : k + block] + np.minimum(step, size[k : k + block] - 1)
                best[k : k + block] = self.logits(w.number[place], x_of, mask)
            np.maximum.at(out, a + text, best)
        return out + self.shift

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Between 0 and 1 for each text; 0 for those without words."""
        logit = self.of_texts(data, offsets)
        return np.where(np.isneginf(logit), 0, 1 / (1 + np.exp(-np.clip(logit, -60, 60))))


def _odds(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Log odds ratio of texts that hold a thing; 0 below 3 texts, and drawn to 0 where there are few."""
    seen = pos + neg
    raw = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    return np.where(seen >= 3, raw * seen / (seen + 8), 0).astype(np.float32) / 4


def _statistics(texts: list[Words], labels: np.ndarray):
    """Word and 4-gram log odds over texts, one ``Words`` for each."""
    keys = np.concatenate([w.keys for w in texts]) if texts else np.zeros(0, np.uint64)
    of = np.repeat(labels, [len(w.keys) for w in texts])
    n_pos, n_neg = int(labels.sum()), int(len(labels) - labels.sum())
    every, number = np.unique(keys, return_inverse=True)
    pos = np.bincount(number, of, len(every))
    odds = _odds(pos, np.bincount(number, minlength=len(every)) - pos, n_pos, n_neg)
    most = np.sort(np.argsort(-np.abs(odds), kind="stable")[:N_WORDS])
    grams = np.zeros((2, 1 << GRAM_BITS))
    for w, y in zip(texts, labels, strict=True):
        grams[int(y), np.unique(w.grams)] += 1
    return every[most], np.append(np.float32(0), odds[most]), _odds(grams[1], grams[0], n_pos, n_neg)


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7, epochs: int = 6, batch: int = 256, rate: float = 0.01, least_steps: int = 400) -> Model:
    """Fits the network to labelled texts (UTF-8).

    Of each text the windows that look most like the positive class take part, as a text counts as positive
    if one of its windows does: at first by the statistics, after half of the epochs by the network. Then
    the logits are shifted to where they part the texts best. Small samples get more epochs, so that at
    least about ``least_steps`` steps are taken.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.int64)
    read = [read_words(np.frombuffer(t, np.uint8), np.array([0, len(t)], np.int64)) for t in texts]
    keep = [k for k, w in enumerate(read) if len(w.number)]
    read, texts, labels = [read[k] for k in keep], [texts[k] for k in keep], labels[keep]
    keys, word_odds, gram_odds = _statistics(read, labels)
    f = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
    p = {"words": np.zeros((len(keys) + 1, WORD_DIM), np.float32), "chars": 0.1 * f(1 << GRAM_BITS, CHAR_DIM)}
    for way in "fb":
        p |= {"w" + way: f(INPUT, 3 * HIDDEN), "u" + way: f(HIDDEN, 3 * HIDDEN), "b" + way: np.zeros(3 * HIDDEN, np.float32)}
    p |= {"wa": f(2 * HIDDEN, ATTENTION), "ba": np.zeros(ATTENTION, np.float32), "va": f(ATTENTION), "wo": f(2 * HIDDEN, 1), "bo": np.zeros(1, np.float32)}
    model = Model(p, keys, word_odds, gram_odds)
    if not len(labels) or labels.min() == labels.max():
        model.p["wo"] *= 0
        model.shift = -4.0 if not len(labels) or labels[0] == 0 else 4.0
        return model
    raw = np.frombuffer(b"".join(texts), np.uint8)
    w = read_words(raw, np.cumsum([0, *map(len, texts)]))
    text, start, size = windows(w.at)
    x = model.inputs(w)
    hint = (x[:, -1] + x[:, -2])[w.number]
    hint = np.array([hint[s : s + n].max() for s, n in zip(start, size, strict=True)])
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    steps = 0
    batch = min(batch, max(32, len(labels) // 8))
    epochs = max(epochs, -(-least_steps * batch // (2 * len(labels))))
    for epoch in range(epochs):
        if epoch == epochs // 2:
            hint = _window_logits(model, w, start, size)
        order = np.lexsort((-hint, text))
        rank = np.arange(len(order)) - np.searchsorted(text, np.arange(len(labels)))[text[order]]
        chosen = order[(rank < 1) | ((labels[text[order]] == 0) & (rng.random(len(order)) < 0.08) & (rank < 30))]
        chosen = chosen[rng.permutation(len(chosen))]
        for k in range(0, len(chosen), batch):
            pick = chosen[k : k + batch]
            steps += 1
            grads = _gradients(model, w, start[pick], size[pick], labels[text[pick]])
            for name, g in grads.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[name] -= rate * (1 - epoch / epochs) * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-7)
    logit = np.full(len(labels), -np.inf)
    np.maximum.at(logit, text, _window_logits(model, w, start, size))
    order = np.argsort(logit, kind="stable")
    wrong = np.concatenate([[0], np.cumsum(labels[order] * 2 - 1)])  # positives below the cut less negatives there
    best = np.flatnonzero(wrong == wrong.min())
    cuts = np.concatenate([[logit.min() - 2], (logit[order][1:] + logit[order][:-1]) / 2, [logit.max() + 2]])
    model.shift = -float(cuts[best[len(best) // 2]])
    return model


def _window_logits(model: Model, w: Words, start: np.ndarray, size: np.ndarray, block: int = 2048) -> np.ndarray:
    x = model.inputs(w)
    x_of = {way: x @ model.p["w" + way] + model.p["b" + way] for way in "fb"}
    out = np.empty(len(start), np.float32)
    for k in range(0, len(start), block):
        step = np.arange(WINDOW)[:, None]
        mask = (step < size[k : k + block]).astype(np.float32)
        out[k : k + block] = model.logits(w.number[start[k : k + block] + np.minimum(step, size[k : k + block] - 1)], x_of, mask)
    return out


def _gradients(model: Model, w: Words, start: np.ndarray, size: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss over some windows, by back-propagation through time."""
    p, d = model.p, HIDDEN
    step = np.arange(WINDOW)[:, None]
    mask = (step < size).astype(np.float32)
    number = w.number[start + np.minimum(step, size - 1)]
    used, local = np.unique(number, return_inverse=True)
    local = local.reshape(number.shape)
    count = np.diff(np.append(w.first, len(w.grams)))[used]
    first = np.cumsum(count) - count
    sub = Words(w.at, local, w.keys[used], w.grams[ranges(w.first[used], count)], first)
    x = model.inputs(sub)
    kept: dict[str, list] = {"f": [], "b": []}
    both = [model._states(way, (x @ p["w" + way] + p["b" + way])[local], mask, kept[way]) for way in "fb"]
    states = np.concatenate(both, 2)
    a, share, pooled, logit = model._pool(states, mask)
    dl = ((_sigmoid(logit[:, 0]) - y) / len(y)).astype(np.float32)
    g = {"wo": pooled.T @ dl[:, None], "bo": np.array([dl.sum()], np.float32)}
    dpool = dl[:, None] * p["wo"][:, 0]
    dstates = share[:, :, None] * dpool
    dshare = np.einsum("tbh,bh->tb", states, dpool)
    ds = share * (dshare - (share * dshare).sum(0))
    g["va"] = np.einsum("tb,tba->a", ds, a)
    da = ds[:, :, None] * p["va"] * (1 - a * a)
    g["wa"] = np.einsum("tbh,tba->ha", states, da)
    g["ba"] = da.sum((0, 1))
    dstates += da @ p["wa"].T
    dx = np.zeros_like(x)
    for way, part in zip("fb", (dstates[:, :, :d], dstates[:, :, d:]), strict=True):
        dgates = np.zeros((*local.shape, 3 * d), np.float32)
        du, dh = np.zeros_like(p["u" + way]), np.zeros((local.shape[1], d), np.float32)
        for t, h, z, r, new, gn in reversed(kept[way]):
            dh = (dh + part[t]) * mask[t][:, None]
            dnew = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dnew * gn * r * (1 - r)
            dg = np.concatenate([dz, dr, dnew * r], 1)
            du += h.T @ dg
            dgates[t] = np.concatenate([dz, dr, dnew], 1)
            dh = dh * z + dg @ p["u" + way].T
        g["u" + way] = du
        per_word = np.zeros((len(used), 3 * d), np.float32)
        np.add.at(per_word, local.ravel(), dgates.reshape(-1, 3 * d))
        g["b" + way] = per_word.sum(0)
        g["w" + way] = x.T @ per_word
        dx += per_word @ p["w" + way].T
    g["words"] = np.zeros_like(p["words"])
    np.add.at(g["words"], model.word_numbers(sub.keys), dx[:, :WORD_DIM])
    g["chars"] = np.zeros_like(p["chars"])
    np.add.at(g["chars"], sub.grams, np.repeat(dx[:, WORD_DIM : WORD_DIM + CHAR_DIM] / count[:, None].astype(np.float32), count, 0))
    return g
