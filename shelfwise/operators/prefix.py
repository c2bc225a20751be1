"""Running totals inside keys of any size, and what follows from them: counts in a time range and next-eligible rows.

Rows are ranged over all tasks by key and order, so a key with a third of all rows fills a third of the tasks. Totals run inside
a range; only the first key of a range can have begun before it, so what is carried into ranges is one row each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import cut_lineage


def running_totals(
    rows: DataFrame, key: str, order: Sequence[str], totals: Mapping[str, Column], inclusive: bool = True, partitions: int | None = None
) -> DataFrame:
    """Add the sum of each of ``totals`` over the rows of the same key up to this one (or before it) in ``order``.

    ``order`` must tell the rows of a key apart. Rows without a key are left out.
    """
    spark = rows.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = rows.filter(F.col(key).isNotNull()).select("*", *[value.alias(f"__{name}") for name, value in totals.items()])
    ranged = cut_lineage(known.repartitionByRange(parts, key, *order).withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy("__range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    summed = ranged.groupBy(key, "__range").agg(*[F.sum(f"__{name}").alias(f"__{name}") for name in totals])
    before = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = summed.select(key, "__range", F.count(F.lit(1)).over(before).alias("__earlier"), *[F.sum(f"__{name}").over(before).alias(f"__carry_{name}") for name in totals])
    carried = carried.filter("__earlier > 0").drop("__earlier")  # at most one key of each range
    with_inside = ranged.select("*", *[F.sum(f"__{name}").over(inside).alias(name) for name in totals])
    joined = with_inside.join(F.broadcast(carried), [key, "__range"], "left")
    sums = {name: F.coalesce(name, F.lit(0)) + F.coalesce(f"__carry_{name}", F.lit(0)) for name in totals}
    return joined.withColumns(sums).drop("__range", *[f"__{name}" for name in totals], *[f"__carry_{name}" for name in totals])


def _probed(counted: DataFrame, asked: DataFrame, key: str, at: str, row_id: str, probes: Mapping[int, Column]) -> DataFrame:
    """Rows (kind 1) and probes for the rows of ``asked`` with ``n``, the rows of their key up to them by (time, kind)."""
    row = counted.select(key, F.col(at).alias("at"), F.lit(1).alias("kind"), F.col(row_id).alias("id"))
    for kind, moment in probes.items():
        row = row.unionByName(asked.select(key, moment.alias("at"), F.lit(kind).alias("kind"), F.col(row_id).alias("id")))
    return running_totals(row, key, ["at", "kind", "id"], {"n": F.when(F.col("kind") == 1, 1).otherwise(0).cast("long")})


def counts_in_range(rows: DataFrame, key: str, at: str, row_id: str, span: str, counted: DataFrame | None = None) -> DataFrame:
    """key, row_id and ``n``: rows of the same key from ``span`` before a row's time up to that time, both included.

    What ``count(*) over (partition by key order by at range between span preceding and current row)`` gives, without a window
    over a key. ``row_id`` is unique; ``counted`` may name other rows to count, with the same columns.
    """
    probes = {0: F.col(at) - F.expr(f"interval {span}"), 2: F.col(at)}
    found = _probed(rows if counted is None else counted, rows, key, at, row_id, probes).filter("kind <> 1")
    n = F.sum(F.when(F.col("kind") == 2, F.col("n")).otherwise(-F.col("n")))
    return found.groupBy(key, F.col("id").alias(row_id)).agg(n.alias("n"))


def next_after(rows: DataFrame, key: str, at: str, row_id: str, span: str) -> DataFrame:
    """key, row_id, ``place`` (1, 2, ... inside the key by time and id) and ``next``: the place of the first row at least
    ``span`` later (one beyond the last place if there is none)."""
    found = _probed(rows, rows, key, at, row_id, {0: F.col(at) + F.expr(f"interval {span}")})
    place = F.max(F.when(F.col("kind") == 1, F.col("n")))
    follower = F.max(F.when(F.col("kind") == 0, F.col("n") + 1))
    return found.groupBy(key, F.col("id").alias(row_id)).agg(place.alias("place"), follower.alias("next"))


def spaced(rows: DataFrame, key: str, at: str, row_id: str, span: str) -> DataFrame:
    """Rows that a walk through each key in time order takes, each at least ``span`` after the one taken before.

    The walk is a chain of next-eligible links. Links double round by round, and the rows known to be on the chain reach as
    many more through the doubled links: as many rounds as the longest chain has binary digits, whatever a key's size.
    """
    links = cut_lineage(next_after(rows, key, at, row_id, span))
    jump = links.select(key, "place", "next")
    taken = jump.filter("place = 1").select(key, "place")
    while True:
        reached = taken.join(jump, [key, "place"]).select(key, F.col("next").alias("place"))
        reached = cut_lineage(reached.join(links.select(key, "place"), [key, "place"], "left_semi"))
        if reached.isEmpty():
            break
        taken = cut_lineage(taken.unionByName(reached))
        to = jump.select(key, F.col("place").alias("next"), F.col("next").alias("further"))
        jump = cut_lineage(jump.join(to, [key, "next"]).select(key, "place", F.col("further").alias("next")))
    kept = links.join(taken, [key, "place"]).select(row_id)
    return rows.join(kept, row_id)
