"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Spans come from patterns: ``split`` gives the lengths of the gaps between matches, and a running sum over
a text's gaps and matches gives places, in code points. A candidate's value is then looked up over the
whole corpus by hash: by how many distinct repositories and owners hold it. A value that ``WIDE`` or more
owners hold is a copied example; one that a single owner holds, in ``FEW`` repositories at most, and that looks
random, is a live credential. What one owner has copied through many repositories is neither. The method also
finds values where they stand bare, without a name before them. Owners are sources; a document counts as a
repository of its own where no column tells more.

Counting goes over distinct (value, owner, repository) rows made before the shuffle, and lookups join
tables on disk, so that Spark can split a value that a third of all rows hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import cut, table

#: Kinds in order, and their patterns; fixed values. Group 2 (else the match) is the value.
KINDS = ("assign", "access", "hex", "bare")
NAME = "password|passwd|secret|token|api_?key"
VALUE = "[A-Za-z0-9+/_.=-]+"
RUN = "[A-Za-z0-9+/_-]"
PATTERNS = {
    "assign": rf"""((?i:{NAME}))["']?\x20*[:=]\x20*["']?({VALUE})""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}+",
    "bare": f"(?<!{RUN})(?=[A-Za-z+/_-]*+[0-9]){RUN}{{20,}}+",
}
#: An assigned value has so many characters.
LEAST_VALUE = 6
#: A value that so many owners hold is an example.
WIDE = 3
#: A value that more repositories hold isn't live, even if they are of one owner.
FEW = 10
#: A live-looking value has so many characters, and so many different ones.
LIVE_CHARS, LIVE_KINDS = 16, 8


def _matches(text: Column, kind: str) -> Column:
    """Array of (gap, match, value) of a kind: the code points before each match since the last one, and the match."""
    pattern = F.lit(PATTERNS[kind])
    group = F.lit(2 if kind == "assign" else 0)
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
    found = F.arrays_zip(
        F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), F.regexp_extract_all(text, pattern, group).alias("value")
    )
    found = F.transform(found, lambda x: F.struct(x["gap"].alias("gap"), F.length(x["match"]).alias("size"), x["value"].alias("value")))
    return F.when(text.rlike(PATTERNS[kind]), found)


def looks_live(value: Column) -> Column:
    """Long, with many different characters, and a digit."""
    return (F.length(value) >= LIVE_CHARS) & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_KINDS) & value.rlike("[0-9]")


def scan(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "doc_id")) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, text_h) of ``docs`` and their spans (row, kind_no, kind, start, end, verdict).

    verdict: "example", "live" or "other". Owner and repository columns may be null: null is one owner.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("text_h"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repository]).alias("repository"),
        *[_matches(text, k).alias(k) for k in KINDS],
    )
    rows = cut(rows)
    found = None
    for no, kind in enumerate(KINDS):
        part = rows.where(F.col(kind).isNotNull()).select("row", "owner", "repository", F.lit(no).alias("kind_no"), F.posexplode(kind).alias("i", "m"))
        found = part if found is None else found.unionByName(part)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(Window.partitionBy("row", "kind_no").orderBy("i"))
    found = found.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.col("m.size"))
    found = found.where((F.col("kind_no") != 0) | (F.length("m.value") >= LEAST_VALUE))
    # A bare run inside a span of another kind isn't news: the largest end of those that start no later tells.
    over = Window.partitionBy("row").orderBy("start", "kind_no", "end").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("reach", F.max(F.when(F.col("kind_no") < 3, F.col("end"))).over(over))
    found = found.where((F.col("kind_no") < 3) | F.coalesce(F.col("reach") < F.col("end"), F.lit(True)))
    value = F.regexp_replace("m.value", "[=.]+$", "")
    found = cut(found.select("row", "owner", "repository", "kind_no", "start", "end", F.xxhash64(value).alias("h"), F.sha2(value, 256).alias("value_sha"), looks_live(value).alias("random")))

    holders = found.groupBy("h", "value_sha", "owner", "repository").agg(F.max("random").alias("random"), F.min("kind_no").alias("first"))
    owners = holders.groupBy("h", "value_sha", "owner").agg(F.count("*").alias("n"), F.max("random").alias("random"), F.min("first").alias("first"))
    verdicts = owners.groupBy("h", "value_sha").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"), F.max("random").alias("random"), F.min("first").alias("first"))
    verdict = F.when(F.col("n_owners") >= WIDE, "example").when((F.col("n_owners") == 1) & (F.col("n_repositories") <= FEW) & F.col("random"), "live").otherwise("other")
    verdicts = cut(verdicts.select("h", "value_sha", "n_owners", "n_repositories", "first", verdict.alias("verdict")))
    spans = found.join(verdicts, ["h", "value_sha"])
    # Bare runs count only where the same value is a credential elsewhere.
    spans = spans.where((F.col("kind_no") < 3) | (F.col("first") < 3))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1)
    return rows.select("row", "doc_id", "text_h"), spans.select("row", "kind_no", name.alias("kind"), "start", "end", "verdict", "n_owners", "n_repositories")


def secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "doc_id")) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_bare, n_live, n_example, holders.

    holders: for each span, in the order of spans, owners/repositories that hold its value.

    Null and empty texts have no spans. Rows that repeat a doc_id are scanned each for itself; other columns
    than doc_id, text and those of owner and repository are ignored.
    """
    rows, spans = scan(docs, owner, repository)
    label = F.concat_ws(":", "kind", "start", "end")
    listed = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind_no", "end", label.alias("label"), F.concat_ws("/", "n_owners", "n_repositories").alias("held")))).alias("all"),
        *[F.sum((F.col("kind_no") == k).cast("long")).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        *[F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}") for v in ("live", "example")],
    )
    base = F.array_join(F.transform(F.filter("all", lambda x: x["kind_no"] < 3), lambda x: x["label"]), ",")
    counts = ["n_assign", "n_access", "n_hex", "n_bare", "n_live", "n_example"]
    listed = listed.select("row", *counts, base.alias("base"), F.array_join(F.col("all")["label"], ",").alias("spans"), F.array_join(F.col("all")["held"], ",").alias("holders"))
    out = rows.join(listed, "row", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in counts}
    return out.select(
        "doc_id", *[zero[c].alias(c) for c in counts[:3]], F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), *[zero[c].alias(c) for c in counts[3:]], F.coalesce("holders", F.lit("")).alias("holders"),
    )


MASK = "[SECRET]"


def redact(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "doc_id")) -> DataFrame:
    """``docs`` with each credential that isn't a widely copied example replaced by ``MASK``, in columns text and n_chars.

    Spans that overlap or touch become one mask. Documents without credentials stay as they are.
    """
    rows, spans = scan(docs, owner, repository)
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.where("verdict <> 'example'").withColumn("reach", F.max("end").over(before))
    run = F.sum((F.col("reach").isNull() | (F.col("start") > F.col("reach"))).cast("int"))
    spans = spans.withColumn("run", run.over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("row", "run").agg(F.min("start").alias("s"), F.max("end").alias("e"))
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans_"))
    # Rows of one doc_id and one text are redacted alike.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    spans = cut(rows.join(spans, "row").select(key.alias("id_"), F.col("text_h").alias("h_"), "spans_").dropDuplicates(["id_", "h_"]))
    # The rows travel as one struct, so that columns of theirs can have any names.
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(F.struct(*docs.columns).alias("row_"), key.alias("id_"), F.xxhash64(text).alias("h_")).join(spans, ["id_", "h_"], "left")
    n, text = F.size("spans_"), F.col("row_.text")

    def piece(i: Column) -> Column:
        begin = F.coalesce(F.get("spans_", i - 1)["e"], F.lit(0))
        end = F.coalesce(F.get("spans_", i)["s"], F.length(text))
        return F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))

    masked = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n), piece), MASK)).otherwise(text)
    out = out.withColumn("text_", masked)
    new = {c: F.col(f"row_.`{c}`") for c in docs.columns} | {"text": F.col("text_")}
    if "n_chars" in new:
        new["n_chars"] = F.when(n > 0, F.length("text_").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return out.select(*[new[c].alias(c) for c in docs.columns])


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


_DUCK = {
    "assign": rf"""((?i:{NAME}))["'']?\x20*[:=]\x20*["'']?({VALUE})""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "bare": f"{RUN}{{20,}}",
}

OP5_SQL = (
    "with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, coalesce(source, '') as owner, "
    "coalesce(source, '') || '/' || coalesce(cast(doc_id as varchar), '') as repository from documents), k as ("
    + " union all ".join(
        f"select rid, owner, repository, {no} as kind_no, '{kind}' as kind, regexp_extract_all(t, '{p}', 0) as m, "
        f"regexp_extract_all(t, '{p}', {2 if kind == 'assign' else 0}) as v, string_split_regex(t, '{p}') as g from d where regexp_matches(t, '{p}')"
        for no, (kind, p) in enumerate(_DUCK.items())
    )
    + f"""), e as (select rid, owner, repository, kind_no, kind, unnest(m) as m, unnest(v) as v, unnest(g[1:len(m)]) as g, unnest(range(len(m))) as i from k),
p as (select *, sum(length(g) + length(m)) over (partition by rid, kind_no order by i) as fin from e),
q as (select rid, owner, repository, kind_no, kind, cast(fin - length(m) as bigint) as s, cast(fin as bigint) as fin, regexp_replace(v, '[=.]+$', '') as v from p
  where (kind_no <> 0 or length(v) >= {LEAST_VALUE}) and (kind_no <> 3 or regexp_matches(v, '[0-9]'))),
r as (select *, max(case when kind_no < 3 then fin end) over (partition by rid order by s, kind_no, fin rows between unbounded preceding and current row) as reach from q),
f as (select *, length(v) >= {LIVE_CHARS} and len(list_distinct(string_split(v, ''))) >= {LIVE_KINDS} and regexp_matches(v, '[0-9]') as random from r where kind_no < 3 or reach is null or reach < fin),
w as (select v, count(distinct owner) as n_owners, count(distinct repository) as n_repositories, bool_or(random) as random, min(kind_no) as first from f group by v),
x as (select f.rid, f.kind_no, f.s, f.fin, f.kind || ':' || f.s || ':' || f.fin as label,
  n_owners || '/' || n_repositories as held, case when n_owners >= {WIDE} then 'example' when n_owners = 1 and n_repositories <= {FEW} and w.random then 'live' else 'other' end as verdict
  from f join w using (v) where f.kind_no < 3 or w.first < 3),
y as (select rid, count(*) filter (kind_no = 0) as n_assign, count(*) filter (kind_no = 1) as n_access, count(*) filter (kind_no = 2) as n_hex, count(*) filter (kind_no = 3) as n_bare,
  count(*) filter (verdict = 'live') as n_live, count(*) filter (verdict = 'example') as n_example,
  string_agg(label, ',' order by s, kind_no, fin) filter (kind_no < 3) as base, string_agg(label, ',' order by s, kind_no, fin) as spans,
  string_agg(held, ',' order by s, kind_no, fin) as holders from x group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_bare, 0) as n_bare, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example, coalesce(holders, '') as holders
from d left join y using (rid)"""
)
