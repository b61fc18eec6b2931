"""Mixing sources to target weights: hierarchical budgets, then a prefix of each leaf's seeded epochs.

Weights belong to the nodes of a tree (domain, language, source). From the root down, a node's budget is
shared among its children by weight; a child can take no more than its subtree can supply, and what it
leaves goes to its siblings by weight, before any of it could go to its parent's siblings: a node only
gets less than its share if its whole subtree is short. Shares are whole tokens by largest remainders, so
that children get exactly what their parent has, and the mixture as a whole exactly its target.

A leaf with budget b and t tokens gives b div t whole epochs, and of one more epoch, ordered by a seeded
hash, the documents that begin before the b mod t-th token. Where that prefix ends is found by radix
descent over the hash: token sums of 64 ranges for each leaf, three times over, and an order by rows
only within the last range. So a leaf with a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import cut, table

WHITE = "[\\x20\\x09-\\x0D]"
#: Bits of the order's hash, and of a step of the descent.
ORDER_BITS, STEP_BITS, STEPS = 60, 6, 3
#: A table of at most so many leaves is broadcast, which spares the rows a shuffle by leaf; larger ones are joined by shuffle.
MOST_LEAVES = 50_000


def _of_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves``: a checkpointed table, whose size is looked up."""
    return F.broadcast(leaves) if leaves.limit(MOST_LEAVES + 1).count() <= MOST_LEAVES else leaves


def n_words(text: Column) -> Column:
    """Runs of characters that aren't white space; 0 for null."""
    t = F.coalesce(text, F.lit(""))
    ends = F.when((t == "") | t.rlike(f"^{WHITE}"), 1).otherwise(0) + F.when(t.rlike(f"{WHITE}$"), 1).otherwise(0)
    return (F.size(F.split(t, f"{WHITE}+", -1)) - ends).cast("long")


def place(seed: str, epoch: Column, doc_id: Column) -> Column:
    """A document's place in its leaf's epoch: 60 bits of a hash."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 15), 16, 10).cast("long")


def _share(nodes: DataFrame, parents: list[str], name: str, weight: str) -> DataFrame:
    """``nodes``: parents, name, supply, weight, parent_budget. Adds ``budget``, by filling in order of supply / weight.

    Sums and products are decimals: exact at any size. Of those that aren't short each can take one token more
    than its share rounded down, as its supply is above the share; as many do as tokens are left, those with the
    largest remainders, ties by name.
    """
    whole = lambda c: c.cast("decimal(38,0)")
    supply, each, total = whole(F.col("supply")), whole(F.col(weight)), whole(F.col("parent_budget"))
    upto = Window.partitionBy(*parents).orderBy(F.col("supply") / F.col(weight), name).rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy(*parents)
    out = nodes.withColumns({"s": F.sum("supply").over(upto), "w": F.sum(weight).over(upto), "every": F.sum(weight).over(all_)})
    out = out.withColumn("short", whole(F.col("s")) * each + supply * whole(F.col("every") - F.col("w")) <= total * each)
    out = out.withColumns({"given": F.coalesce(F.sum(F.when(F.col("short"), F.col("supply"))).over(all_), F.lit(0)), "gone": F.coalesce(F.sum(F.when(F.col("short"), F.col(weight))).over(all_), F.lit(0))})
    left, parts = whole(F.col("parent_budget") - F.col("given")) * each, F.when(~F.col("short"), whole(F.col("every") - F.col("gone")))
    out = out.withColumn("rest_", (left % parts).cast("long"))
    out = out.withColumn("least", ((left - whole(F.col("rest_"))) / parts).cast("long"))
    by_rest = Window.partitionBy(*parents).orderBy(F.col("short"), F.desc("rest_"), name)
    out = out.withColumns({"more": F.col("parent_budget") - F.col("given") - F.sum("least").over(all_), "n_": F.row_number().over(by_rest)})
    budget = F.when(F.col("short"), F.col("supply")).otherwise(F.col("least") + (F.col("n_") <= F.col("more")).cast("long"))
    return out.withColumn("budget", budget).drop("s", "w", "every", "short", "given", "gone", "rest_", "least", "more", "n_")


def budgets(leaves: DataFrame, levels: list[str], weights: list[Column], target: Column, max_epochs: int) -> DataFrame:
    """``leaves``: levels, tokens. Returns levels, tokens, budget (tokens) for each leaf."""
    nodes = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    whole = nodes.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("supply"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    above = whole.select(F.least("supply", target.cast("long")).alias("parent_budget"))
    for k, name in enumerate(levels):
        parents = levels[:k]
        here = nodes.groupBy(*levels[: k + 1]).agg(F.sum("supply").cast("long").alias("supply")).withColumn("weight", weights[k].cast("long"))
        here = here.crossJoin(above) if k == 0 else here.join(above, parents)  # the root is one row
        above = _share(here, parents or [F.lit(0)], name, "weight").select(*levels[: k + 1], F.col("budget").alias("parent_budget"))
    return nodes.select(*levels, "tokens").join(above, levels).withColumnRenamed("parent_budget", "budget")


def plan(units: DataFrame, levels: list[str], weights: list[Column], target: Column, max_epochs: int, seed: str) -> DataFrame:
    """For each leaf: levels, budget, epochs (whole ones), rest (tokens of the last epoch), and its last document there.

    ``units``: levels, doc_id, tokens (over 0, one row for each document of a leaf). ``last``: struct of place
    and doc_id, ``last_take``: how many of its tokens belong to the prefix; null where the rest is 0.
    """
    leaves = units.groupBy(*levels).agg(F.sum("tokens").cast("long").alias("tokens"))
    got = budgets(leaves, levels, weights, target, max_epochs)
    got = got.withColumn("epochs", F.expr("budget div tokens")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    got = cut(got.select(*levels, "budget", "epochs", "rest"))
    left = units.join(_of_leaves(got).where("rest > 0"), levels).withColumn("o", place(seed, F.col("epochs"), F.col("doc_id"))).select(*levels, "doc_id", "tokens", "rest", "o")
    for step in range(STEPS):
        digit = F.shiftright("o", ORDER_BITS - STEP_BITS * (step + 1)).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
        left = left.withColumn("digit", digit)
        sums = left.groupBy(*levels, "rest", "digit").agg(F.sum("tokens").alias("t"))
        upto = Window.partitionBy(*levels).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        at = sums.withColumn("upto", F.sum("t").over(upto)).where("upto >= rest and upto - t < rest")
        at = cut(at.select(*levels, "digit", (F.col("rest") - F.col("upto") + F.col("t")).cast("long").alias("inner")))
        left = left.join(_of_leaves(at), [*levels, "digit"]).withColumn("rest", F.col("inner")).drop("digit", "inner")
    upto = Window.partitionBy(*levels).orderBy("o", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    last = left.withColumn("upto", F.sum("tokens").over(upto)).where("upto >= rest and upto - tokens < rest")
    last = last.select(*levels, F.struct("o", "doc_id").alias("last"), (F.col("rest") - F.col("upto") + F.col("tokens")).cast("long").alias("last_take"))
    return cut(got.join(last, levels, "left"))


def taken(rows: DataFrame, leaf_plan: DataFrame, levels: list[str], seed: str) -> DataFrame:
    """``rows`` (levels, doc_id, ...) once for each epoch that takes them: adds epoch, whole, last_take."""
    out = rows.join(_of_leaves(leaf_plan), levels)
    here = F.struct(place(seed, F.col("epochs"), F.col("doc_id")).alias("o"), F.col("doc_id").alias("doc_id"))
    part = F.when((F.col("rest") > 0) & (here <= F.col("last")), F.array(F.col("epochs"))).otherwise(F.array().cast("array<bigint>"))
    whole = F.when(F.col("epochs") > 0, F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("is_last", here == F.col("last")).withColumn("epoch", F.explode(F.concat(whole, part)))
    return out.withColumn("is_last", F.col("is_last") & (F.col("epoch") == F.col("epochs")))


def leaf_keys(domain: Column, language: str = "lang", source: str = "source") -> dict[str, Column]:
    """domain, lang and source of a row; null is a leaf of its own, "(none)"."""
    return {k: F.coalesce(c.cast("string"), F.lit("(none)")) for k, c in (("domain", domain), ("lang", F.col(language)), ("source", F.col(source)))}


def mix(docs: DataFrame, domain: Column, weights: list[Column], share: float = 1.0, max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """Returns domain, lang, source, doc_id, epoch, tokens, take: one row for each document and epoch that takes it.

    ``weights``: for domain, language and source, from columns domain, lang and source; positive whole numbers.
    ``share``: the target, as a share of all tokens (words). ``take``: the tokens taken; less than ``tokens``
    for the last document of a prefix only. Documents without words, null texts too, are never taken. Rows
    of a leaf that repeat a doc_id count as one document; a null doc_id is one, too.
    """
    levels = ["domain", "lang", "source"]
    units = docs.select(*[c.alias(k) for k, c in leaf_keys(domain).items()], "doc_id", n_words(F.col("text")).alias("tokens")).where("tokens > 0")
    units = cut(units.groupBy(*levels, "doc_id").agg(F.sum("tokens").cast("long").alias("tokens")))
    target = F.floor(F.col("tokens") * F.lit(share))
    out = taken(units, plan(units, levels, weights, target, max_epochs, seed), levels, seed)
    take = F.when(F.col("is_last"), F.col("last_take")).otherwise(F.col("tokens"))
    return out.select(*levels, "doc_id", "epoch", "tokens", take.alias("take"))


def mixed(docs: DataFrame, domain: Column, weights: list[Column], share: float, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, whole, that one epoch takes: ``share`` of all tokens, by weight. The last document of a prefix counts as taken."""
    levels = ["domain", "lang", "source"]
    # The rows travel as one struct, so that columns of theirs can have any names.
    named = docs.select(F.struct(*docs.columns).alias("row_"), *[c.alias(k) for k, c in leaf_keys(domain).items()], "doc_id", n_words(F.col("text")).alias("n_tokens")).where("n_tokens > 0")
    units = named.select(*levels, "doc_id", F.col("n_tokens").alias("tokens"))
    units = cut(units.groupBy(*levels, "doc_id").agg(F.sum("tokens").cast("long").alias("tokens")))
    leaf_plan = plan(units, levels, weights, F.floor(F.col("tokens") * F.lit(share)), 1, seed)
    return taken(named.drop("n_tokens"), leaf_plan, levels, seed).select("row_.*")


#: The mixture of the query: fixed values. Weights of domains, languages and sources.
DOMAIN_SQL = "case when substr(md5(source), 1, 1) < '8' then 'web' else 'books' end"
WEIGHTS_SQL = ["case domain when 'web' then 3 else 2 end", "case lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end", "case source when 'src0' then 4 else 1 end"]
SHARE, EPOCHS, SEED = 1.0, 2, "mix"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), F.expr(DOMAIN_SQL), [F.expr(w) for w in WEIGHTS_SQL], SHARE, EPOCHS, SEED)


def mixture_sql(docs: str, domain: str, weights: list[str], share: float, max_epochs: int, seed: str) -> str:
    """The SQL of ``mix`` for DuckDB, straight from the definition: every leaf's epoch is sorted whole."""
    levels = ["domain", "lang", "source"]
    sql = f"""with d as (select coalesce({domain}, '(none)') as domain, coalesce(lang, '(none)') as lang, coalesce(source, '(none)') as source, doc_id,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n from {docs}),
u as (select domain, lang, source, doc_id, cast(sum(n) as bigint) as tokens from d where n > 0 group by all),
leaf as (select domain, lang, source, sum(tokens) as tokens, sum(tokens) * {max_epochs} as supply from u group by all),
b0 as (select least(coalesce(sum(supply), 0), floor(coalesce(sum(tokens), 0) * cast({share} as double))) as budget from leaf)"""
    for k in range(3):
        cols, up = ", ".join(levels[: k + 1]), ", ".join(f"c.{x}" for x in levels[: k + 1])
        on = " and ".join(f"c.{x} = p.{x}" for x in levels[:k]) or "true"
        part = f"partition by {', '.join(levels[:k])}" if k else ""
        sql += f""",
c{k} as (select {cols}, sum(supply) as supply, {weights[k]} as weight from leaf group by {cols}),
j{k} as (select {up}, c.supply, c.weight, p.budget as b from c{k} c join b{k} p on {on}),
f{k} as (select *, sum(supply) over ({part} order by supply / weight, {levels[k]} rows unbounded preceding) as s, sum(weight) over ({part} order by supply / weight, {levels[k]} rows unbounded preceding) as w,
  sum(weight) over ({part}) as every from j{k}),
g{k} as (select *, cast(s as hugeint) * weight + cast(supply as hugeint) * cast(every - w as hugeint) <= cast(b as hugeint) * weight as short from f{k}),
h{k} as (select *, coalesce(sum(supply) filter (short) over ({part}), 0) as given, coalesce(sum(weight) filter (short) over ({part}), 0) as gone from g{k}),
i{k} as (select *, case when not short then cast(b - given as hugeint) * weight // cast(every - gone as hugeint) end as low, case when not short then cast(b - given as hugeint) * weight % cast(every - gone as hugeint) end as rem from h{k}),
n{k} as (select *, b - given - sum(low) over ({part}) as more, row_number() over ({part} order by short, rem desc, {levels[k]}) as n from i{k}),
b{k + 1} as (select {cols}, cast(case when short then supply else low + case when n <= more then 1 else 0 end end as bigint) as budget from n{k})"""
    return sql + f""",
q as (select leaf.domain, leaf.lang, leaf.source, cast(tokens as bigint) as all_tokens, budget // cast(tokens as bigint) as epochs, budget % cast(tokens as bigint) as rest from leaf join b3 using (domain, lang, source)),
o as (select u.*, epochs, rest, cast('0x' || substr(md5(concat_ws(':', '{seed}', epochs, coalesce(cast(doc_id as varchar), 'null'))), 1, 15) as bigint) as o from u join q using (domain, lang, source)),
p as (select *, sum(tokens) over (partition by domain, lang, source order by o, doc_id nulls first rows unbounded preceding) - tokens as before from o)
select domain, lang, source, doc_id, cast(epoch as bigint) as epoch, tokens, tokens as take from (select *, unnest(range(epochs)) as epoch from o)
union all select domain, lang, source, doc_id, cast(epochs as bigint), tokens, cast(least(tokens, rest - before) as bigint) from p where before < rest"""


OP1_SQL = mixture_sql("documents", DOMAIN_SQL, WEIGHTS_SQL, SHARE, EPOCHS, SEED)
