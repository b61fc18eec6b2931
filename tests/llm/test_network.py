"""The recurrent network against plain loops, and its gradients against differences."""

import re
import zlib

import numpy as np
import pytest

from tilewright.llm import bigru, op03_toxicity
from tilewright.llm._numpy_text import hash_spans


def texts_of(rng, n, longest=90):
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "Zu", "é") for b in ("", "x", "tt", "ß", "qqqq")]
    return [" ".join(rng.choice(vocabulary, int(rng.integers(1, longest)))) + "," * int(rng.integers(0, 3)) for _ in range(n)]


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_logit(model, text):
    """The text's logit, word by word and step by step."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    words = [w for w in re.split(rb"[^0-9A-Za-z\x80-\xff]+", low) if w]
    inputs = []
    for w in words:
        raw = np.frombuffer(w, np.uint8)
        key = hash_spans(raw, np.array([0]), np.array([len(w)]))[0]
        at = np.flatnonzero(model.keys == key)
        k = int(at[0]) + 1 if len(at) else 0
        marked = b"\x02" + w + b"\x03" * max(1, 3 - len(w))
        grams = [int.from_bytes(marked[i : i + 4], "little") * 2654435761 % 2**32 >> (32 - bigru.GRAM_BITS) for i in range(len(marked) - 3)]
        inputs.append(np.concatenate([p["words"][k], np.mean([p["chars"][g] for g in grams], 0), [model.word_odds[k]], [max(model.gram_odds[g] for g in grams)]]))
    best = -np.inf
    starts = [0, *range(bigru.STRIDE, max(1, len(words) - bigru.WINDOW + bigru.STRIDE), bigru.STRIDE)] if words else []
    d = bigru.HIDDEN
    for s in starts:
        window = inputs[s : s + bigru.WINDOW]
        states = []
        for way in "fb":
            h, out = np.zeros(d), []
            for x in window if way == "f" else window[::-1]:
                gx, gh = x @ p["w" + way] + p["b" + way], h @ p["u" + way]
                z, r = sigmoid(gx[:d] + gh[:d]), sigmoid(gx[d : 2 * d] + gh[d : 2 * d])
                h = (1 - z) * np.tanh(gx[2 * d :] + r * gh[2 * d :]) + z * h
                out.append(h)
            states.append(out if way == "f" else out[::-1])
        states = [np.concatenate(x) for x in zip(*states, strict=True)]
        weight = np.exp([np.tanh(x @ p["wa"] + p["ba"]) @ p["va"] for x in states])
        pooled = np.average(states, 0, weight)
        best = max(best, float((pooled @ p["wo"] + p["bo"])[0]))
    return best + model.shift


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    texts = texts_of(rng, 200)
    return bigru.train([t.encode() for t in texts], np.array(["Zu" in t[:20] for t in texts], int), epochs=2, least_steps=20)


def test_forward(model):
    rng = np.random.default_rng(2)
    texts = [*texts_of(rng, 25), "one", "", " ,", "a" * 300, *texts_of(rng, 3, 400)]
    data, at = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *[len(t.encode()) for t in texts]])
    got, score = model.of_texts(data, at), model.scores(data, at)
    for t, g, s in zip(texts, got, score, strict=True):
        want = plain_logit(model, t)
        assert (np.isneginf(want) and np.isneginf(g) and s == 0) or abs(g - want) < 1e-3 * (1 + abs(want))
        assert np.isneginf(want) or abs(s - sigmoid(want)) < 1e-3


def test_all_windows_count(model):
    """A word far into a long text changes its score as soon as it would as a text of its own window."""
    rng = np.random.default_rng(3)
    calm = " ".join(["lo", "mi"] * 300)
    loud = texts_of(rng, 1, 33)[0]
    of = lambda t: model.of_texts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
    for place in (0, 301, 590):
        w = calm.split()
        w[place:place] = loud.split()
        assert of(" ".join(w)) >= of(calm) - 1e-5 and abs(of(" ".join(w)) - plain_logit(model, " ".join(w))) < 1e-2


def test_gradients(model):
    rng = np.random.default_rng(4)
    raw = "".join(texts_of(rng, 1, 200)).encode()
    w = bigru.read_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    _, start, size = bigru.windows(w.at)
    y = rng.integers(0, 2, len(start))
    old = model.p
    model.p = {k: v.astype(np.float64) for k, v in old.items()}

    def loss():
        x = model.inputs(w).astype(np.float64)
        x_of = {way: x @ model.p["w" + way] + model.p["b" + way] for way in "fb"}
        step = np.arange(bigru.WINDOW)[:, None]
        logit = model.logits(w.number[start + np.minimum(step, size - 1)], x_of, (step < size).astype(np.float64)).astype(np.float64)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    try:
        grads = bigru._gradients(model, w, start, size, y)
        used = set(w.grams.tolist())
        for name, g in grads.items():
            flat = model.p[name].reshape(-1)
            places = rng.choice(len(flat), min(len(flat), 6), replace=False) if name not in ("chars", "words") else [k * model.p[name].shape[1] for k in (sorted(used)[:4] if name == "chars" else [0])]
            for k in places:
                was, eps = flat[k], 1e-2
                flat[k] = was + eps
                up = loss()
                flat[k] = was - eps
                down = loss()
                flat[k] = was
                assert abs((up - down) / (2 * eps) - g.reshape(-1)[k]) < 2e-3 + 0.05 * abs(g.reshape(-1)[k]), (name, k)
    finally:
        model.p = old


def test_folds(spark):
    """Held out are ids whose crc32 as text is a multiple of 5; their labels change nothing."""
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    docs = ids.selectExpr("doc_id", "concat(if(doc_id % 3 = 0, 'foul words ', 'kind words '), doc_id) as text")
    out = ids.select("doc_id", op03_toxicity.held_out(ids.doc_id).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = {r.doc_id for r in out if r.h}
    one, other = (spark.createDataFrame([(k, int(k % 3 == 0) if k not in held else flip) for k in range(200)], "doc_id long, toxic int") for flip in (0, 1))
    a, b = (op03_toxicity.fit(docs, labels) for labels in (one, other))
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p) and a.shift == b.shift
