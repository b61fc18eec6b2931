"""Preference formatting, in DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role, same
text) is rendered once, as the prompt; what follows in each is a completion, with a mask that tells which
of its characters are learned from: the texts of the assistant's turns and the marks that end them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table

#: A rendered turn: fixed values.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def turns_of(table_: DataFrame, key: str) -> DataFrame:
    """(key, turns): the turns in order, as structs of turn, role and text; null roles and texts count as empty."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return table_.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """A run for each turn, skipped+learned characters (code points), joined by commas."""

    def run(t: Column) -> Column:
        head, body = F.length(t["role"]) + len(OPEN) + len(CLOSE), F.length(t["text"]) + len(END)
        learned = t["role"] == LEARNED
        return F.concat(F.when(learned, head).otherwise(head + body).cast("string"), F.lit("+"), F.when(learned, body).otherwise(F.lit(0)).cast("string"))

    return F.array_join(F.transform(turns, run), ",")


def _rest(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))


def format_pairs(pairs: DataFrame, key: str) -> DataFrame:
    """``pairs``: key, chosen and rejected arrays of turns. Returns key, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask.

    Equal conversations are all prompt, and their completions are empty. A null array counts as no turns.
    """
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    pairs = pairs.select(key, *[F.coalesce(F.col(c), none).alias(c) for c in ("chosen", "rejected")])
    both = F.zip_with("chosen", "rejected", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(both, F.lit(False))
    pairs = pairs.withColumn("n_common", F.when(first == 0, F.size("chosen")).otherwise(first - 1).cast("int"))
    n = F.col("n_common")
    sides = {c: _rest(F.col(c), n) for c in ("chosen", "rejected")}
    return pairs.select(
        key, "n_common", _rendered(F.slice("chosen", F.lit(1), n)).alias("prompt"),
        *[_rendered(x).alias(c) for c, x in sides.items()], *[_mask(x).alias(f"{c}_mask") for c, x in sides.items()],
    )


def worse_reply(conversations: DataFrame) -> DataFrame:
    """Pairs (conv_id, chosen, rejected): a conversation, and the same up to one of its replies, with that one taken from another conversation.

    Which reply depends on conv_id (its number among the replies is conv_id modulo how many there are), so that
    pairs part at different turns; the rejected conversation ends with it. Conversations 2 i and 2 i + 1 lend
    each other their last replies; where the other one has none, or doesn't exist, the reply is empty. A
    conversation without a reply is its own rejected one. A null conv_id counts as 0 here and borrows nothing.
    """
    turns = turns_of(conversations.select("conv_id", "turn", "role", "text"), "conv_id")
    places = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: F.get(F.col("turns"), i)["role"] == LEARNED)
    turns = turns.withColumn("replies", places)
    n = F.size("replies")
    mine = F.get(F.col("replies"), F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)).cast("long"), F.nullif(n.cast("long"), F.lit(0).cast("long"))).cast("int"))
    turns = turns.withColumns({"at": F.coalesce(mine, F.lit(-1)), "last": F.get(F.col("replies"), n - 1)}).drop("replies")
    lent = turns.where("last is not null").select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.get("turns", F.col("last"))["text"].alias("lent"))
    out = turns.join(lent, "conv_id", "left")
    text = lambda t, i: F.when(i == F.col("at"), F.coalesce(F.col("lent"), F.lit(""))).otherwise(t["text"])
    kept = F.when(F.col("at") >= 0, F.slice("turns", F.lit(1), F.col("at") + 1)).otherwise(F.col("turns"))
    rejected = F.transform(kept, lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), text(t, i).alias("text")))
    return out.select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(worse_reply(table(spark, sf_dir, "conversations")), "conv_id")


def _sql_side(side: str) -> str:
    shown = f"concat('{OPEN}', t.role, '|>', chr(10), t.text, '<|end|>', chr(10))"
    head, body = f"length(t.role) + {len(OPEN) + len(CLOSE)}", f"length(t.text) + {len(END)}"
    run = f"concat(case when t.role = '{LEARNED}' then {head} else {head} + {body} end, '+', case when t.role = '{LEARNED}' then {body} else 0 end)"
    rest = f"{side}[n_common + 1:]"
    return f"coalesce(array_to_string(list_transform({rest}, lambda t: {shown}), ''), '') as {side}, coalesce(array_to_string(list_transform({rest}, lambda t: {run}), ','), '') as {side}_mask"


OP10_SQL = f"""with a as (select conv_id, list({{'turn': turn, 'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as chosen from conversations group by conv_id),
b as (select *, list_filter(range(1, len(chosen) + 1), lambda i: chosen[i].role = '{LEARNED}') as replies from a),
p as (select *, case when len(replies) > 0 then replies[coalesce(conv_id, 0) % len(replies) + 1] else 0 end as pos, case when len(replies) > 0 then replies[len(replies)] else 0 end as fin from b),
c as (select p.conv_id, p.chosen, p.pos, coalesce(o.chosen[o.fin].text, '') as lent from p left join p o on o.conv_id = xor(p.conv_id, 1) and o.fin > 0),
d as (select conv_id, chosen, list_transform(range(1, case when pos > 0 then pos else len(chosen) end + 1), lambda i: {{'turn': chosen[i].turn, 'role': chosen[i].role, 'text': case when i = pos then lent else chosen[i].text end}}) as rejected from c),
e as (select *, cast(coalesce(list_min(list_filter(range(1, len(rejected) + 1), lambda i: chosen[i].text <> rejected[i].text)) - 1, len(rejected)) as integer) as n_common from d)
select conv_id, n_common, coalesce(array_to_string(list_transform(chosen[1:n_common], lambda t: concat('{OPEN}', t.role, '|>', chr(10), t.text, '<|end|>', chr(10))), ''), '') as prompt,
{_sql_side("chosen")}, {_sql_side("rejected")} from e"""
