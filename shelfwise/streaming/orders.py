"""New-order alerts as a stream: each order is alerted once, when it is first seen in a watched status."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.orders import alerts, watched
from shelfwise.session import cut_lineage
from shelfwise.sources.keyed import folder_names

ALERT_COLUMNS = "id bigint, text string"
OUTBOX_BUCKETS = 256


def order_stream(spark: SparkSession, folder: str, schema, pattern: str = "*", files_per_trigger: int | None = None) -> DataFrame:
    """Order snapshots as they arrive. ``files_per_trigger`` bounds the first read of a large backlog."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def first_sightings(orders: DataFrame, horizon: str = "30 days") -> DataFrame:
    """Watched orders, each id once within ``horizon`` of processing time.

    Ids are kept in the state store, hashed over all tasks and dropped after the horizon; the outbox itself decides about
    ids seen before that. The clock is the time an order is read, not its order date, so old orders that reach a watched
    status late are still alerted.
    """
    seen = watched(orders).withColumn("seen_at", F.current_timestamp())
    return seen.withWatermark("seen_at", horizon).dropDuplicatesWithinWatermark(["id"])


def outbox_bucket(order_id: Column) -> Column:
    return F.pmod(F.xxhash64(order_id.cast("bigint")), F.lit(OUTBOX_BUCKETS)).cast("int")


def start_alerts(
    orders: DataFrame, outbox: str, checkpoint: str, horizon: str = "30 days", enrich: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Write alerts to the outbox, each order once for good.

    ``enrich`` looks up items and city for the orders of a batch (they may lack both). The outbox lies in buckets by the hash of the
    order id, so a batch looks for its ids in their own buckets only, however long the history is. In a bucket a batch has a
    folder of its own, named by the query's checkpoint and the batch: a replayed batch overwrites just these folders, and
    ids that others hold are left out, so a rescan repeats nothing.
    """
    spark = orders.sparkSession
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12] + "-" + fresh_mark(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage((batch if enrich is None else enrich(batch)).withColumn("bucket", outbox_bucket(F.col("id"))))
        sent = sent_ids(spark, outbox, [r[0] for r in rows.select("bucket").distinct().collect()])  # at most OUTBOX_BUCKETS
        if sent is not None:
            others = sent.filter((F.col("run") != run) | (F.col("batch") != batch_id)).select("id")
            rows = rows.join(others, "id", "left_anti")
        texts = alerts(rows).withColumns({"bucket": outbox_bucket(F.col("id")), "run": F.lit(run), "batch": F.lit(batch_id)})
        by_bucket = texts.repartition(F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        by_bucket.partitionBy("bucket", "run", "batch").parquet(outbox)

    return (
        first_sightings(orders, horizon)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def sent_ids(spark: SparkSession, outbox: str, buckets: list[int]) -> DataFrame | None:
    """id, run and batch of the alerts in some buckets; no other bucket is listed or read. None if there are none."""
    held = set(folder_names(spark, outbox))
    paths = [f"{outbox}/bucket={b}" for b in buckets if f"bucket={b}" in held]
    if not paths:
        return None
    return spark.read.schema("id bigint, bucket int, run string, batch bigint").option("basePath", outbox).parquet(*paths).select("id", "run", "batch")


def fresh_mark(spark: SparkSession, checkpoint: str) -> str:
    """A mark that stays with a checkpoint: read from beside its offsets, or made there for a new one."""
    path = f"{checkpoint}/shelfwise-run"
    try:
        return spark.read.schema("mark string").json(path).first().mark
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    mark = uuid.uuid4().hex[:12]
    spark.range(1).select(F.lit(mark).alias("mark")).coalesce(1).write.json(path)
    return mark


def read_outbox(spark: SparkSession, outbox: str) -> DataFrame | None:
    """id, text and file of all alerts; none before the first batch."""
    try:
        found = spark.read.schema(ALERT_COLUMNS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(outbox)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.select("id", "text", F.col("_metadata.file_path").alias("file"))
