"""The pipeline against a plain version of its stages."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import corpus_pipeline as p
from test_minhash import brute
from tilewright.llm import op01_mix, op03_toxicity
from tilewright.llm._shared import table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
PLAIN = {"access": re.compile("AKIA[A-Z0-9]{16,}"), "hex": re.compile("[0-9a-f]{24,}"), "bare": re.compile("[A-Za-z0-9+/_-]{20,}")}


def spans(text):
    """(start, end, kind_no, value) of all candidates."""
    out = [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), k, m[0]) for k, x in enumerate(PLAIN.values(), 1) for m in x.finditer(text) if k < 3 or re.search("[0-9]", m[0])]
    base = [s for s in out if s[2] < 3]
    return [(s, e, k, re.sub("[=.]+$", "", v)) for s, e, k, v in out if k < 3 or not any(b[0] <= s and b[1] >= e for b in base)]


def masked(docs):
    found = {d: spans(t) for d, t, _, _ in docs}
    owners, first = defaultdict(set), defaultdict(lambda: 9)
    for d, _, _, source in docs:
        for _, _, k, v in found[d]:
            owners[v].add(source)
            first[v] = min(first[v], k)
    out = []
    for d, t, lang, source in docs:
        merged = []
        for s, e, k, v in sorted(found[d]):
            if len(owners[v]) >= 3 or (k == 3 and first[v] == 3):
                continue
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(e, merged[-1][1])
            else:
                merged.append([s, e])
        for s, e in reversed(merged):
            t = t[:s] + "[SECRET]" + t[e:]
        out.append((d, t, lang, source))
    return out


def fill(total, children):
    """children: name to (supply, weight). Budgets by repeated redistribution of what full ones leave, to the last token."""
    left, open_, got = total, dict(children), {}
    while open_:
        level = Fraction(left, sum(w for _, w in open_.values()))
        full = [n for n, (s, w) in open_.items() if s <= level * w]
        if not full:
            low = {n: int(level * w) for n, (s, w) in open_.items()}
            order = sorted(open_, key=lambda n: (low[n] - level * open_[n][1], n))
            return got | {n: low[n] + (k < left - sum(low.values())) for k, n in enumerate(order)}
        for n in full:
            got[n] = open_[n][0]
            left -= open_.pop(n)[0]
    return got


def mixed(docs, share):
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t, _, _ in docs}
    leaf = {d: ("web" if hashlib.md5(s.encode()).hexdigest()[0] < "8" else "books", lang, s) for d, _, lang, s in docs}
    weight = [lambda x: 3 if x == "web" else 2, lambda x: {"en": 6, "de": 2, "fr": 2}.get(x, 1), lambda x: 4 if x == "src0" else 1]
    supply = defaultdict(int)
    for d, n in words.items():
        for k in range(4):
            supply[leaf[d][:k]] += n
    budget = {(): int(supply[()] * share)}
    for k in range(3):
        for node in [n for n in budget if len(n) == k]:
            children = {n: (s, weight[k](n[-1])) for n, s in supply.items() if len(n) == k + 1 and n[:k] == node and s}
            budget |= fill(budget[node], children)
    kept = set()
    for node, b in budget.items():
        epoch = b // supply[node] if len(node) == 3 else 0
        if len(node) == 3 and epoch:
            kept |= {d for d in leaf if leaf[d] == node and words[d]}
        elif len(node) == 3:
            order = sorted((int(hashlib.md5(f"mix:0:{d}".encode()).hexdigest()[:15], 16), d) for d in leaf if leaf[d] == node and words[d])
            at = 0
            for _, d in order:
                if at < b:
                    kept.add(d)
                at += words[d]
    return [x for x in docs if x[0] in kept]


def test_stages(spark, medium):
    docs = table(spark, medium, "documents")
    of = lambda df: sorted((r.doc_id, r.text, r.lang, r.source) for r in df.collect())
    rows = of(docs)
    model = op03_toxicity.fit(docs, table(spark, medium, "labels"))
    toxic = {r.doc_id for r in op03_toxicity.score(docs, model).where("predicted = 1").collect()}
    want = [x for x in rows if x[0] not in toxic]
    step = p.toxicity(spark, docs, medium)
    assert step.schema == docs.schema and of(step) == want
    group = brute([x[:2] for x in want], 5, 80)
    step, want = p.near_dedup(spark, step, medium), [x for x in want if group[x[0]][1] == x[0]]
    assert step.columns == docs.columns and of(step) == want
    step, want = p.secrets(spark, step, medium), masked(want)
    assert step.schema == docs.schema and of(step) == want and any("[SECRET]" in x[1] for x in want)
    assert all(r.n_chars == len(r.text) for r in step.collect() if "[SECRET]" in r.text)
    step, want = p.mixture(spark, step, medium), mixed(want, p.SHARE)
    assert step.columns == docs.columns and of(step) == want
    out = p.run(spark, medium).collect()
    assert {r.doc_id for r in out} == {x[0] for x in want}
    fill_ = defaultdict(int)
    for r in out:
        fill_[r.sequence_id] += r.length
    assert max(fill_.values()) <= 4096


def test_odd_rows(spark, small):
    """Null ids and texts, repeated rows and an extra column go through every stage that returns documents."""
    rows = [(1, "a b c d e f", "en", "s", 11, 0), (1, "a b c d e f", "en", "s", 11, 0), (None, "x y z", None, None, None, 1), (2, None, "en", "s", None, 2), (3, "", "de", "s", 0, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int")
    docs = docs.withColumns({c: p.F.lit(7) for c in ("row_", "id_", "h_", "spans_", "text_", "n_", "domain", "tokens", "lang_", "kept", "rep", "sig", "epoch", "o")})
    got = p.near_dedup(spark, docs, "")
    assert got.columns == docs.columns and sorted(str(r.doc_id) for r in got.collect()) == ["1", "2", "3", "None"]
    redacted = p.secrets(spark, docs, "")
    assert redacted.columns == docs.columns and redacted.count() == 5 and {r.lang_ for r in redacted.collect()} == {7}
    assert {tuple(r)[6:] for r in p.mixture(spark, docs, "").collect()} == {(7,) * 14}
    assert op01_mix.mixed(docs, p.F.lit("d"), [p.F.lit(1)] * 3, 1.0).columns == docs.columns
    # Of 15 tokens 13 are taken: the domain of the row without a source gives its 3, that of s 10 of its one document's 12.
    assert fill(13, {"web": (12, 3), "books": (3, 2)}) == {"web": 10, "books": 3}
    assert sorted(str(r.doc_id) for r in p.mixture(spark, docs, "").collect()) == ["1", "1", "None"]
    assert p.toxicity(spark, docs, small).count() == len(rows) and sorted(str(r.doc_id) for r in p.packing(spark, docs, "").collect()) == ["1", "1", "2", "3", "None"]


def test_empty_and_long(spark, small, tmp_path):
    """An empty table goes through all stages, and so does a text of a million words."""
    from tilewright.llm._shared import table as read

    docs = read(spark, small, "documents")
    read(spark, small, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert p.run(spark, f"file://{tmp_path}").count() == 0
    words = " ".join(f"word{k % 7919}" for k in range(1_000_000))
    long = spark.createDataFrame([(1, words, "en", "s", len(words)), (2, words + " token=abcdefgh12345678", "en", "t", 0), (3, "a few words that stand here", "de", "s", 27)], docs.schema)
    for name, stage in p.STAGES[:4]:
        if name == "toxicity":
            long = spark.createDataFrame(stage(spark, long, small).collect(), docs.schema)
            kept = sorted(r.doc_id for r in long.collect())
            assert 3 in kept
        else:
            long = spark.createDataFrame(stage(spark, long, small).collect(), docs.schema)
    assert all("abcdefgh12345678" not in r.text for r in long.collect())
    assert p.packing(spark, long, small).count() >= long.count()


def test_near_dedup_of_repeated_and_missing_ids(spark):
    """Unlike texts under one doc_id stay; copies go, with or without a doc_id."""
    a, b, c = ("one two three four five six seven", "red green blue black white grey pink", "north south east west up down left")
    rows = [(1, a), (1, b), (1, a), (2, b), (None, c), (None, c), (None, a), (3, "other words that stand only here once"), (None, "and these are in no other row")]
    got = p.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.text for r in got.collect()) == sorted({t for _, t in rows})
