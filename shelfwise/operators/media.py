"""Per-product roll-ups of image metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.classify import classify_images
from shelfwise.functions.media import image_gate_reasons, large_stone_candidate
from shelfwise.operators.staging import computed


def image_verdicts(metrics: DataFrame) -> DataFrame:
    """PASS or FAIL per image with its reasons and the path to import.

    ``metrics``: product_id, position, original_path, processed_path, mean_drift, p95_drift, channel_drift,
    detail_ratio, same_size, icc_lost, alpha_lost, checksum_changed.
    """
    gated = metrics.withColumn(
        "reasons",
        image_gate_reasons(
            *[
                F.col(c)
                for c in (
                    "mean_drift",
                    "p95_drift",
                    "channel_drift",
                    "detail_ratio",
                    "same_size",
                    "icc_lost",
                    "alpha_lost",
                    "checksum_changed",
                )
            ]
        ),
    )
    passed = F.size("reasons") == 0
    return gated.select(
        "product_id",
        "position",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        "reasons",
        (~passed).alias("fallback_to_original"),
        F.when(passed, F.col("processed_path")).otherwise(F.col("original_path")).alias("import_path"),
    )


def media_rollup(verdicts: DataFrame) -> DataFrame:
    """Per product: PASS when every image passes, and whether the first image was approved.

    The ordered import paths stay as rows (``verdicts`` by position), so no product's images meet in one list.
    """
    return verdicts.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("images"),
        F.when(F.every(F.col("status") == "PASS"), "PASS").otherwise("FAIL").alias("qa_status"),
        (F.min_by("status", "position") == "PASS").alias("featured_approved"),
        F.count_if(F.col("fallback_to_original")).alias("fallbacks"),
    )


def view_votes(views: DataFrame) -> DataFrame:
    """Stone verdict per product from its views. ``views``: product_id, readable, share, concentration."""
    candidate = F.col("readable") & large_stone_candidate(F.col("share"), F.col("concentration"))
    counted = views.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.count_if(F.col("readable")).alias("readable"),
        F.count_if(candidate).alias("qualifying"),
    )
    return counted.withColumn("vote", classify_images(F.col("readable"), F.col("qualifying"))).select(
        "product_id", "views", "readable", "qualifying", "vote.*"
    )


def histogram_percentile(rows: DataFrame, histogram: str, percentile: float, name: str) -> DataFrame:
    """Add the first of 256 levels whose running three-channel count reaches the share. Nothing is shuffled.

    ``histogram`` holds 3 x 256 counts. The level counts and the threshold are computed once per row.
    """
    third = [F.slice(histogram, start, 256) for start in (1, 257, 513)]
    counts = F.zip_with(F.zip_with(third[0], third[1], lambda a, b: a + b), third[2], lambda a, b: a + b)
    summed = computed(rows, __counts=counts)
    total = F.aggregate("__counts", F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    ready = computed(summed, __threshold=total * F.lit(percentile))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).alias("level"))

    def step(acc: Column, count: Column) -> Column:
        seen = acc["seen"] + count
        return F.struct(seen.alias("seen"), (acc["level"] + (seen < F.col("__threshold")).cast("int")).alias("level"))

    level = F.aggregate("__counts", start, step)["level"]
    return ready.withColumn(name, F.least(level, F.lit(255)).cast("double")).drop("__counts", "__threshold")
