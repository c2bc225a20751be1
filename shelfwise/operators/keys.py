"""Building blocks for keyed work that stay even when one key holds a large share of the rows.

* ``lookup``       – left/inner join to a side with one row per key; hot keys are spread over salts by their size
* ``mark_repeats`` – first-wins by an aggregate (combined before the shuffle) and a join on the unique row order
* ``top_per_group``– ranked cut per group; Spark keeps only k rows per group and task before the shuffle
* ``dense_order``  – position in a global order without a single-task window
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import cut_lineage

HOT_ROWS = 1_000_000
MAX_SHARE = 256


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` (one row per key) on ``on``.

    Hot keys are those with more than ``hot_rows`` left rows. To find them cheaply, keys are counted over a fixed
    hash share of the rows (the same share on every evaluation); the share only steers the spreading, every row is
    joined. A hot key gets as many salts as it has times ``hot_rows`` rows, so no salt holds many more than that, and only
    the matching right rows are repeated. There are at most (left rows / ``hot_rows``) hot keys, which bounds the broadcast
    list: a million entries at 10^12 rows. Nulls match nothing and are spread over all tasks. Rows are spread by a hash of
    ``spread``: columns that identify a left row and are not the key. ``counted`` may name a cheaper frame with the same
    keys and ``spread`` columns, such as the frame a chain of lookups started from. Where the left side is unique on the
    key there is nothing to spread: use a plain join.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in spread])
    share = max(1, min(MAX_SHARE, hot_rows // 1000))
    source = left if counted is None else counted
    hot = (
        source.filter(F.col(on).isNotNull() & (F.pmod(row_hash, F.lit(share)) == 0))
        .groupBy(on)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > hot_rows // share)
        .select(F.col(on).alias("__hot"), F.ceil(F.col("__n") * share / hot_rows).cast("int").alias("__salts"))
    )
    turn = F.shiftright(row_hash, 16)
    salt = F.when(F.col(on).isNull(), F.pmod(turn, F.lit(1 << 30)).cast("int")).when(F.col("__hot").isNotNull(), F.pmod(turn, F.col("__salts")).cast("int")).otherwise(F.lit(0))
    salted_left = left.join(F.broadcast(hot), F.col(on) == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot", "__salts")
    own = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.col("__salts") - 1)).otherwise(F.array(F.lit(0)))
    salted_right = right.join(F.broadcast(hot), F.col(on) == F.col("__hot"), "left").withColumn("__salt", F.explode(own)).drop("__hot", "__salts")
    return salted_left.join(salted_right, [on, "__salt"], how).drop("__salt")


def mark_repeats(df: DataFrame, key: Column, order: Sequence[str], flag: str) -> DataFrame:
    """Add ``flag``: true where an earlier row (by ``order``, unique and ascending) has the same key.

    Rows with a null key never repeat. The hot key is reduced before the shuffle; the join runs on row order.
    """
    keyed = df.select(*order, key.alias("__key")).filter(F.col("__key").isNotNull())
    if len(order) == 1:
        first = keyed.groupBy("__key").agg(F.min(order[0]).alias(order[0])).drop("__key")
    else:
        first = keyed.groupBy("__key").agg(F.min(F.struct(*order)).alias("__first")).select("__first.*")
    first = first.withColumn("__is_first", F.lit(True))
    return (
        df.join(first, list(order), "left")
        .withColumn(flag, key.isNotNull() & F.col("__is_first").isNull())
        .drop("__is_first")
    )


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def repeated_values(df: DataFrame, key: Column, name: str = "value") -> DataFrame:
    """Values seen more than once, with their count."""
    counts = df.select(key.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def dense_order(df: DataFrame, order: Sequence[Column], position: str, partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n in ``order`` (a total order).

    Range partitions are numbered inside and shifted by the sizes of the partitions before them; only the
    partition sizes (one row per partition) meet in one place. The ranged rows are written out so that both
    readers see the same partitions.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (
        ranged.withColumn("__inside", inside)
        .join(F.broadcast(shifts), "__part")
        .withColumn(position, (F.col("__inside") + F.col("__shift")).cast("bigint"))
        .drop("__part", "__inside", "__shift")
    )
