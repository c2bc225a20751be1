"""Inventory audit and repricing driven by arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.audit import anomaly_counts, anomaly_rows
from shelfwise.operators.repricing import changes, reprice
from shelfwise.streaming.orders import fresh_mark


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_inventory_audit(products: DataFrame, report: str, checkpoint: str) -> StreamingQuery:
    """Finding counts per arriving snapshot, one folder per run and batch."""
    run = fresh_mark(products.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        anomaly_counts(anomaly_rows(batch)).write.mode("overwrite").parquet(f"{report}/run={run}/batch={batch_id}")

    return _run(products, write, checkpoint)


def start_repricing(rates: DataFrame, products: Callable[[], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Price changes for the newest rate of each batch. ``rates``: rate, set_at. ``products`` reads the table anew."""
    run = fresh_mark(rates.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max_by("rate", "set_at").alias("rate")).filter("rate > 0")
        changes(reprice(products(), newest)).write.mode("overwrite").parquet(f"{target}/run={run}/batch={batch_id}")

    return _run(rates, write, checkpoint)
