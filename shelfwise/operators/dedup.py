"""Round-robin discovery, greedy multi-key claims, duplicate codes, run summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.keys import HOT_ROWS, lookup, repeated_values, top_per_group
from shelfwise.session import cut_lineage

ROUND_CAP = 100
WALK_ROWS = 200_000


def round_robin(links: DataFrame, cap: int = ROUND_CAP) -> DataFrame:
    """One link per group and round until ``cap`` is reached at the end of a round, then first-seen distinct urls.

    ``links``: group_no, position (unique per group), url. A group can supply at most ``cap`` links before the
    cut, so each task keeps ``cap`` rows per group and the running total spans at most ``cap`` rounds.
    """
    ranked = top_per_group(links, ["group_no"], [F.asc("position")], cap)
    sizes = ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.orderBy("rank"))
    rounds = sizes.withColumn("taken", running).agg(
        F.coalesce(F.min(F.when(F.col("taken") >= cap, F.col("rank"))), F.max("rank")).alias("last_round")
    )
    kept = ranked.filter(F.col("rank") <= rounds.scalar())
    return kept.groupBy("url").agg(F.min(F.struct("rank", "group_no")).alias("turn")).select(
        "url", F.col("turn.rank").alias("round_no"), F.col("turn.group_no").alias("group_no")
    )


def first_per_group(links: DataFrame) -> DataFrame:
    """First link of every group."""
    return links.groupBy("group_no").agg(F.min_by("url", "position").alias("url"))


def duplicate_codes(records: DataFrame, code: Column) -> DataFrame:
    return repeated_values(records, F.nullif(F.lower(code), F.lit("")), "code")


def _round(undecided: DataFrame, order: str, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """(rows that come first on every key they have, rows that share no key with these and are not among them)."""
    claimed = sum(F.col(k).isNotNull().cast("int") for k in keys)
    firsts = [undecided.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min(order).alias(order)).select(order) for k in keys]
    first_on = reduce(DataFrame.unionByName, firsts).groupBy(order).agg(F.count(F.lit(1)).alias("__firsts"))
    marked = undecided.join(first_on, order, "left").withColumn("__first", claimed == F.coalesce("__firsts", F.lit(0)))
    marked = cut_lineage(marked.select(order, *keys, "__first"))
    winners, rest = marked.filter("__first").drop("__first"), marked.filter("not __first").drop("__first")
    for k in keys:
        taken = winners.filter(F.col(k).isNotNull()).select(k).withColumn("__taken", F.lit(True))
        rest = lookup(rest, taken, k, [order], hot_rows=hot_rows, counted=undecided).filter(F.col("__taken").isNull()).drop("__taken")
    return winners, cut_lineage(rest)


def _walked(rows: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    """Accepted rows of the sequential walk through each ``__walk`` group."""

    def walk(group: pa.Table) -> pa.Table:
        group = group.sort_by(order)
        claimed: set[tuple[int, object]] = set()
        kept = []
        for at, row in enumerate(zip(*[group.column(k).to_pylist() for k in keys])):
            own = [(i, value) for i, value in enumerate(row) if value is not None]
            if claimed.isdisjoint(own):
                claimed.update(own)
                kept.append(at)
        return group.select([order, *keys]).take(pa.array(kept, pa.int64()))

    return cut_lineage(rows.groupBy("__walk").applyInArrow(walk, rows.select(order, *keys).schema))


def components(rows: DataFrame, order: str, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with ``component``: the least ``order`` among all rows they are linked to by shared keys, over any number of links.

    Every component hooks onto the least one it shares a key with, hooks are followed to their ends by doubling, and the
    merged components go on, so both loops take about the logarithm of the longest chain.
    """
    named = [rows.filter(F.col(k).isNotNull()).select(order, F.concat_ws(":", F.lit(k), F.col(k).cast("string")).alias("__key")) for k in keys]
    member = cut_lineage(reduce(DataFrame.unionByName, named))
    labels = cut_lineage(rows.select(order, F.col(order).alias("component")))
    while True:
        met = member.join(labels, order)
        low = met.groupBy("__key").agg(F.min("component").alias("__low"))
        hooks = lookup(met, low, "__key", [order], hot_rows=hot_rows).groupBy("component").agg(F.min("__low").alias("__to"))
        hooks = cut_lineage(hooks.filter("__to < component"))
        if hooks.isEmpty():
            return rows.join(labels, order)
        while True:
            further = hooks.select(F.col("component").alias("__to"), F.col("__to").alias("__end"))
            hooks = cut_lineage(lookup(hooks, further, "__to", ["component"], hot_rows=hot_rows))
            moved = hooks.filter("__end is not null").limit(1).count()
            hooks = hooks.select("component", F.coalesce("__end", "__to").alias("__to"))
            if not moved:
                break
        labels = lookup(labels, hooks, "component", [order], hot_rows=hot_rows)
        labels = cut_lineage(labels.select(order, F.coalesce("__to", "component").alias("component")))


def greedy_accept(df: DataFrame, order: str, keys: Sequence[str], hot_rows: int = HOT_ROWS, walk_rows: int = WALK_ROWS) -> DataFrame:
    """Rows accepted by walking in ``order`` and refusing any row that shares a key with an accepted one.

    A null key claims nothing. A round accepts the undecided rows that come first on every key (an aggregate per key, then a count
    per row), which are all rows alone on their keys and most others, and drops the undecided rows that share a key with them.
    What is left are rows that wait for others; rows without a chain of shared keys between them don't
    bear on each other. Up to ``walk_rows`` rows are walked as they are; of more, each connected component of up to ``walk_rows``
    rows is walked whole, many to a task, and only larger ones take further rounds. Every step is written to the shared folder, so
    a lost executor costs one step.
    """
    undecided = cut_lineage(df.select(order, *keys))
    accepted: list[DataFrame] = []
    rounds = 1
    while True:
        for _ in range(rounds):
            winners, undecided = _round(undecided, order, keys, hot_rows)
            accepted.append(winners)
        left = undecided.limit(walk_rows + 1).count()
        if left <= walk_rows:
            if left:
                accepted.append(_walked(undecided.withColumn("__walk", F.lit(0)), order, keys))
            break
        parts = cut_lineage(components(undecided, order, keys, hot_rows))
        sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("__size"))
        large = cut_lineage(sizes.filter(F.col("__size") > walk_rows).select("component"))  # at most rows / walk_rows
        small = parts.join(F.broadcast(large), "component", "left_anti")
        walks = max(1, undecided.count() // walk_rows)
        accepted.append(_walked(small.withColumn("__walk", F.pmod(F.xxhash64("component"), F.lit(walks))), order, keys))
        undecided = cut_lineage(parts.join(F.broadcast(large), "component", "left_semi").select(order, *keys))
        if undecided.isEmpty():
            break
        rounds *= 2
    return reduce(DataFrame.unionByName, accepted)


def greedy_claims(
    candidates: DataFrame, order: str, id_key: str, code_key: str, sku_key: str, limit: int | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every candidate with ``reason`` (null = accepted) and the accepted row's id it collides with.

    With a limit, the first accepted rows in order stay and candidates after the last of them are left out.
    """
    coded = candidates.filter(F.col(code_key).isNotNull() & F.col(sku_key).isNotNull())
    accepted = greedy_accept(coded, order, [id_key, code_key, sku_key], hot_rows)
    rows = candidates
    if limit is not None:
        kept = accepted.orderBy(order).limit(limit)
        reached = F.when(F.count(F.lit(1)) >= limit, F.max(order)).alias("last")
        last = cut_lineage(kept.agg(reached)).scalar()
        rows = candidates.filter(last.isNull() | (F.col(order) <= last))
        accepted = kept
    accepted = cut_lineage(accepted)
    marked = rows
    for key, name in ((id_key, "id"), (code_key, "code"), (sku_key, "sku")):
        owner = accepted.select(key, F.col(order).alias(f"__{name}_order"), F.col(id_key).cast("string").alias(f"__{name}_owner"))
        marked = lookup(marked, owner, key, [order], hot_rows=hot_rows, counted=candidates)
    earlier = {n: F.col(f"__{n}_order") < F.col(order) for n in ("id", "code", "sku")}
    reason = (
        F.when(F.col(code_key).isNull() | F.col(sku_key).isNull(), "MISSING_LEGACY_CODE")
        .when(earlier["id"], "DUPLICATE_LEGACY_ID")
        .when(earlier["code"], "DUPLICATE_LEGACY_CODE")
        .when(earlier["sku"], "NORMALIZED_SKU_CONFLICT")
    )
    return (
        marked.withColumn("reason", reason)
        .withColumn(
            "conflicts_with",
            F.when(F.col("reason") == "DUPLICATE_LEGACY_CODE", F.col("__code_owner")).when(
                F.col("reason") == "NORMALIZED_SKU_CONFLICT", F.col("__sku_owner")
            ),
        )
        .drop(*[f"__{n}_{p}" for n in ("id", "code", "sku") for p in ("order", "owner")])
    )


def run_summary(claims: DataFrame, limit: int) -> DataFrame:
    """Counters of a run and, when it fell short, why."""
    accepted = F.count_if(F.col("reason").isNull())
    return claims.agg(
        F.lit(limit).alias("requested_limit"),
        accepted.alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"),
        F.count(F.lit(1)).alias("candidates"),
    ).withColumn(
        "incomplete_reason",
        F.when(
            F.col("accepted") < limit,
            F.concat(
                F.lit("only "),
                F.col("accepted").cast("string"),
                F.lit(" unique-code products collected from "),
                F.col("candidates").cast("string"),
                F.lit(" candidates"),
            ),
        ),
    )
