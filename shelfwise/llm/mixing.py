"""Mixing sources to target weights by hierarchical budgeting.

The columns of ``levels`` span a tree (domain, language, source). The budget of tokens starts at the root; a node shares
its budget among its children by weight, and a child can take no more than its whole subtree can supply in ``epochs``
passes. What a child can't take goes to its siblings, by weight again; only what all of them together can't take is
short at the parent, whose own siblings then get it. As a node is never given more than its subtree supplies, every
shortage is settled at the lowest level that can.

A leaf's stream is its documents in seeded order, pass after pass; its prefix of ``target`` tokens is taken, the last
document in part. The order is a hash with 4,096 buckets per leaf and pass: token sums per bucket give the bucket in
which the prefix ends, all rows before it are taken as they stream by, and only rows of that bucket are ordered. No leaf
is ever gathered, so a source with a third of all rows costs no more per task than the others.

Defined results: a null or missing level value is the value ``''``; null texts and texts without words supply nothing and are
not taken; a weight of zero or less takes nothing, an unnamed value weighs 1; repeated rows are rows of their own
(repeats of a whole row tie and are taken in any order); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import cut_lineage

BUCKET_DIGITS = 3
ADDED = ("epoch", "tokens", "take_tokens", "target_tokens")


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def seeded(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def weight_of(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, weight in (weights.get(level) or {}).items():
        out = F.when(F.col(level) == value, float(weight)).otherwise(out)
    return out


def shared_out(children: DataFrame, parents: DataFrame, up: Sequence[str], weight: Column) -> DataFrame:
    """``target`` of every child: the parent's target split by weight, no child above its ``capacity``, nothing left over
    that a sibling could take. ``parents`` holds ``up`` and ``target``."""
    rows = children.withColumn("weight", F.greatest(weight, F.lit(0.0)))
    rows = rows.join(parents.withColumnRenamed("target", "budget"), list(up)) if up else rows.withColumn("budget", parents.scalar())
    group = Window.partitionBy(*up) if up else Window.partitionBy(F.lit(0))
    order = group.orderBy("full_at", *[c for c in children.columns if c != "capacity"])
    rows = rows.withColumn("full_at", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf"))))
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("full", F.col("weight").__gt__(0) & (F.col("full_at") * after <= F.col("budget") - before))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(group), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(group)
    share = F.when(F.col("full"), F.col("capacity").cast("double")).when(open_weight > 0, F.col("weight") * rest / open_weight).otherwise(0.0)
    return rows.withColumn("target", F.least(share, F.col("capacity").cast("double"))).select(*children.columns, "target")


def leaf_targets(supply: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], budget: int | float, epochs: int) -> DataFrame:
    """``target`` tokens per leaf. ``supply``: levels, tokens. A float budget is that share of all tokens."""
    leaves = supply.select(*levels, (F.col("tokens") * epochs).alias("capacity"))
    total = F.coalesce(F.sum("tokens"), F.lit(0)).cast("double")
    wanted = F.lit(float(budget)) if isinstance(budget, int) else total * F.lit(float(budget))
    targets = supply.agg(F.least(wanted, total * epochs).alias("target"))
    for depth in range(1, len(levels) + 1):
        children = leaves.groupBy(*levels[:depth]).agg(F.sum("capacity").alias("capacity"))
        targets = shared_out(children, targets, levels[: depth - 1], weight_of(levels[depth - 1], weights)).drop("capacity")
    return targets.select(*levels, F.floor(F.round("target", 3)).cast("long").alias("target_tokens"))


def mix(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, float]],
    budget: int | float,
    epochs: int = 1,
    seed: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The taken rows with their columns, ``epoch``, ``tokens``, ``take_tokens`` and ``target_tokens`` of their leaf."""
    kept = [c for c in docs.columns if c not in ADDED]
    tree = [f"__level_{c}" for c in levels]
    weights = {f"__level_{c}": w for c, w in weights.items()}
    rows = docs.select(*kept, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(t) for c, t in zip(levels, tree)], token_count(F.col(text)).alias("tokens"))
    levels = tree
    rows = rows.filter(F.col("tokens") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    rows = rows.withColumn("__order", seeded(seed, F.col("epoch"), F.col(doc_id)))
    rows = rows.withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS))

    sums = cut_lineage(rows.groupBy(*levels, "epoch", "__bucket").agg(F.sum("tokens").alias("tokens")))
    supply = sums.filter(F.col("epoch") == 1).groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    targets = cut_lineage(leaf_targets(supply, levels, weights, budget, epochs))

    along = Window.partitionBy(*levels).orderBy("epoch", "__bucket")
    ends = (
        sums.withColumn("__upto", F.sum("tokens").over(along))
        .join(targets, list(levels))
        .filter((F.col("__upto") >= F.col("target_tokens")) & (F.col("target_tokens") > 0))
        .groupBy(*levels, "target_tokens")
        .agg(F.min(F.struct("epoch", "__bucket", (F.col("__upto") - F.col("tokens")).alias("before"))).alias("__end"))
    )
    here = F.struct("epoch", "__bucket")
    end = F.struct(F.col("__end.epoch").alias("epoch"), F.col("__end.__bucket").alias("__bucket"))
    placed = rows.join(cut_lineage(ends), list(levels)).withColumn("__last", here == end)
    whole = placed.filter(here < end).withColumn("take_tokens", F.col("tokens"))
    inside = Window.partitionBy(*levels).orderBy("__order", doc_id, "tokens", F.xxhash64(text))
    upto = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    left = F.col("target_tokens") - F.col("__end.before") - (F.col("__upto") - F.col("tokens"))
    last = placed.filter("__last").withColumn("__upto", upto).withColumn("take_tokens", F.least(F.col("tokens"), left)).filter("take_tokens > 0")
    out = [*kept, *ADDED]
    return whole.select(*out).unionByName(last.select(*out))
