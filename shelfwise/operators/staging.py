"""Compute-once columns and rows dealt over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read instead of expanding.

    Spark pushes a filter below the projection that computes its column and inlines nested expressions, which
    repeats a parsing expression once per use. Columns that come out of a generator are never inlined; this one
    yields exactly one row per input row, inside generated code and without a shuffle.
    """
    kept = [c for c in df.columns if c not in columns]
    staged = df.select(*kept, *[value.alias(f"__{name}") for name, value in columns.items()])
    one = F.array(F.struct(*[F.col(f"__{name}").alias(name) for name in columns]))
    return staged.select(*kept, F.inline(one))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over all tasks by a hash of their columns.

    A compact file is read by as many tasks as it has row groups, often one, and every narrow step after it stays there.
    Spark joins small shuffle partitions again, so a small table still takes one task.
    """
    return df.repartition(F.xxhash64(*df.columns))
