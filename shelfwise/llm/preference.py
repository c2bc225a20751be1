"""Preference pairs: the longest common turn prefix rendered once as prompt, the rest as two masked completions.

``format_pairs`` takes two tables of turns (pair_id, turn, role, text), one of chosen and one of rejected conversations.
Turns are ordered by (turn, role, text) with nulls first; two turns are equal if role and text are (nulls equal each
other). Both sides must open with the same rendering, so the prompt is written once, and each completion carries the spans of
characters to train on: the text of assistant turns and the end mark after it. Everything is built-in expressions; a row
is one pair, and nothing but the turns of one pair ever meets.

Defined results: a null role or text renders as empty; a pair on one side only has an empty other side (no turns, no
common prefix); rows without a pair id take no part; equal conversations give two empty completions; repeated turns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def _turns(side: DataFrame, name: str) -> DataFrame:
    entry = F.struct(F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    ordered = F.array_sort(F.collect_list(entry), _by_turn)
    return side.filter(F.col("pair_id").isNotNull()).groupBy("pair_id").agg(ordered.alias(name))


def _by_turn(a: Column, b: Column) -> Column:
    result = F.lit(0)
    for field in ("text", "role", "turn"):
        x, y = a[field], b[field]
        less = (x.isNull() & y.isNotNull()) | F.coalesce(x < y, F.lit(False))
        more = (y.isNull() & x.isNotNull()) | F.coalesce(x > y, F.lit(False))
        result = F.when(less, -1).when(more, 1).otherwise(result)
    return result


def head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), body(t), F.lit("\n"))), "")


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal in role and text."""
    same = F.zip_with(
        F.slice(a, 1, F.least(F.size(a), F.size(b))),
        F.slice(b, 1, F.least(F.size(a), F.size(b))),
        lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]),
    )
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def trained_spans(turns: Column) -> Column:
    """Character spans (start, end exclusive) of trained text within the rendered turns."""
    span = "array<struct<start:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        low = state["at"] + F.char_length(head(turn))
        high = low + F.char_length(body(turn))
        one = F.array(F.struct(low.cast("int").alias("start"), high.cast("int").alias("end")))
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], one)).otherwise(state["spans"])
        return F.struct((high + 1).cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, rejected (completions), chosen_spans, rejected_spans."""
    both = _turns(chosen, "a").join(_turns(rejected, "b"), "pair_id", "full_outer")
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    fields = "array<struct<turn:bigint,role:string,text:string>>"
    both = both.select("pair_id", *[F.coalesce(F.col(c).cast(fields), none).alias(c) for c in ("a", "b")])
    both = both.withColumn("n_prompt_turns", common_prefix(F.col("a"), F.col("b")))
    rest = [F.slice(F.col(c), F.col("n_prompt_turns") + 1, F.size(c)).alias(c) for c in ("a", "b")]
    cut = both.select("pair_id", "n_prompt_turns", rendered(F.slice("a", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"), *rest)
    return cut.select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        rendered(F.col("a")).alias("chosen"),
        rendered(F.col("b")).alias("rejected"),
        trained_spans(F.col("a")).alias("chosen_spans"),
        trained_spans(F.col("b")).alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from plain conversations: the rejected side ends on a foreign reply.

    The last assistant turn of a conversation is replaced by that of the conversation with the next higher id (by one);
    where there is none the rejected reply is empty. A conversation without an assistant turn is rejected as it stands.
    """
    turns = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = turns.filter(F.col("role") == TRAINED_ROLE)
    last = said.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    donor = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last.text").alias("reply"))
    marked = turns.join(last.select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("last_text")), "conv_id", "left")
    hit = (
        (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(F.col("last_turn")) & F.col("text").eqNullSafe(F.col("last_text"))
    )
    swapped = marked.join(donor, "conv_id", "left").withColumn(
        "text", F.when(hit, F.coalesce(F.col("reply"), F.lit(""))).otherwise(F.col("text"))
    )
    as_pair = ["turn", "role", "text"]
    return turns.select(F.col("conv_id").alias("pair_id"), *as_pair), swapped.select(F.col("conv_id").alias("pair_id"), *as_pair)
