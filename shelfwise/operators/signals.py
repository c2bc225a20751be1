"""Order signals: failed payments, repeated baskets, bursts of orders, unusual amounts, and the tier they add up to.

Every rule works on aggregates or on ranged running totals, so one customer with a third of all rows is spread over all tasks.
Times are event times; rows without a customer carry no signal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.keys import HOT_ROWS, lookup
from shelfwise.operators.prefix import counts_in_range, running_totals

FAILURES, FAILURE_SPAN, FAILURE_STEP = 3, "10 minutes", "1 minute"
REPEAT_SPAN = "10 minutes"
BURST, BURST_SPAN = 5, "1 hour"
RUSH = 24
FACTOR = 3


def window_counts(events: DataFrame, key: str, at: str, span: str, step: str) -> DataFrame:
    """key, start, end and ``n`` of every sliding window that holds events; batch or stream (counts combine before the shuffle)."""
    found = events.filter(F.col(key).isNotNull()).groupBy(F.window(at, span, step), key).agg(F.count(F.lit(1)).alias("n"))
    return found.select(key, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def failure_windows(
    failures: DataFrame, key: str, at: str, limit: int = FAILURES, span: str = FAILURE_SPAN, step: str = FAILURE_STEP
) -> DataFrame:
    """Windows with more than ``limit`` failed payments of one key."""
    return window_counts(failures, key, at, span, step).filter(F.col("n") > limit)


def bursts(orders: DataFrame, key: str, at: str, row_id: str, least: int = BURST, span: str = BURST_SPAN) -> DataFrame:
    """Orders that are at least the ``least``-th of their key within ``span`` up to them, with that number."""
    return counts_in_range(orders, key, at, row_id, span).filter(F.col("n") >= least)


def after_failures(orders: DataFrame, failures: DataFrame, key: str, at: str, row_id: str, limit: int = FAILURES, span: str = FAILURE_SPAN) -> DataFrame:
    """Orders with more than ``limit`` failed payments of their key within ``span`` up to them, with that number."""
    return counts_in_range(orders, key, at, row_id, span, failures).filter(F.col("n") > limit)


def basket_digests(lines: DataFrame, order_id: str, line: Sequence[str]) -> DataFrame:
    """order_id and ``digest`` of the multiset of its lines: the same in whatever order they stand.

    Two independent 64-bit hashes of the lines are summed exactly and kept with the number of lines, so an order of any size is
    combined before the shuffle.
    """
    sums = [F.sum(F.xxhash64(F.lit(seed), *line).cast("decimal(20,0)")) for seed in ("basket", "digest")]
    found = lines.groupBy(order_id).agg(F.count(F.lit(1)).alias("__n"), sums[0].alias("__a"), sums[1].alias("__b"))
    return found.select(order_id, F.sha2(F.concat_ws(":", "__n", "__a", "__b"), 256).alias("digest"))


def repeated_baskets(orders: DataFrame, key: str, at: str, row_id: str, digest: str, span: str = REPEAT_SPAN, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Orders whose key ordered the same basket at most ``span`` before (or at the same time under a smaller id).

    Time is cut into slots of ``span``: an order follows one within ``span`` if its slot holds an earlier one, or
    the slot before holds one that is late enough. A slot's first and last order are all that is needed, so orders are never
    paired.
    """
    width = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval {span})")
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    slot = F.floor(micros / width)
    name = lambda number: F.concat_ws(":", F.col(key).cast("string"), F.col(digest), number.cast("string"))
    known = orders.filter(F.col(key).isNotNull() & F.col(digest).isNotNull())
    own = known.select(key, row_id, micros.alias("__at"), name(slot).alias("__slot"), name(slot - 1).alias("__before"))
    edges = own.groupBy("__slot").agg(F.min(F.struct("__at", F.col(row_id).alias("id"))).alias("__first"), F.max("__at").alias("__last"))
    found = lookup(own, edges.drop("__last"), "__slot", [row_id], hot_rows=hot_rows)
    earlier = edges.select(F.col("__slot").alias("__before"), "__last")
    found = lookup(found, earlier, "__before", [row_id], hot_rows=hot_rows, counted=own)
    after_first = F.struct(F.col("__at"), F.col(row_id).alias("id")) > F.col("__first")
    soon = F.coalesce(F.col("__last") >= F.col("__at") - width, F.lit(False))
    return found.filter(after_first | soon).select(key, row_id)


def own_history(orders: DataFrame, key: str, at: str, row_id: str, amount: str) -> DataFrame:
    """Orders with ``earlier`` (number of the key's orders before) and ``spent`` (their exact total)."""
    return running_totals(orders, key, [at, row_id], {"earlier": F.lit(1).cast("long"), "spent": F.col(amount)}, inclusive=False)


def unusual_amounts(orders: DataFrame, key: str, at: str, row_id: str, amount: str, factor: int = FACTOR) -> DataFrame:
    """Orders above ``factor`` times the mean of the key's earlier orders (compared without division)."""
    found = own_history(orders, key, at, row_id, amount)
    return found.filter((F.col("earlier") > 0) & (F.col(amount) * F.col("earlier") > F.col("spent") * factor))


def above_history(orders: DataFrame, history: DataFrame, key: str, amount: str, factor: int = FACTOR) -> DataFrame:
    """Orders above ``factor`` times the mean of a snapshot of the key's history: key, earlier, spent (one row a key)."""
    known = orders.join(history, key)
    return known.filter((F.col("earlier") > 0) & (F.col(amount) * F.col("earlier") > F.col("spent") * factor)).drop("earlier", "spent")


def tier(bits: Column, severe: int) -> Column:
    """3 for two signals or a severe one, 2 for one, else 1."""
    return F.when((F.bit_count(bits) >= 2) | (bits.bitwiseAND(F.lit(severe)) != 0), 3).when(bits != 0, 2).otherwise(1)


def tiers(orders: DataFrame, row_id: str, signals: Mapping[str, DataFrame], severe: Sequence[str] = ()) -> DataFrame:
    """row_id, ``bits`` (a bit for each of ``signals``, in their order) and ``tier`` of every order. Signals hold row_id."""
    places = {name: 1 << place for place, name in enumerate(signals)}
    rows = None
    for name, found in signals.items():
        marked = found.select(row_id, F.lit(places[name]).alias("bit"))
        rows = marked if rows is None else rows.unionByName(marked)
    bits = rows.groupBy(row_id).agg(F.bit_or("bit").alias("bits"))
    joined = orders.select(row_id).join(bits, row_id, "left").withColumn("bits", F.coalesce("bits", F.lit(0)))
    return joined.withColumn("tier", tier(F.col("bits"), sum(places[name] for name in severe)))
