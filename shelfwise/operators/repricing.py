"""Daily repricing: new price per product, change list, reason counts, largest moves, audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import parsing as P, text as T
from shelfwise.functions.pricing import delta_percent, mode_price, price_reason
from shelfwise.operators.staging import computed


def reprice(products: DataFrame, rate: DataFrame, namespace: str | None = None) -> DataFrame:
    """Every product with its old price, new price, reason and change.

    ``products``: id, sku, name, regular_price, meta map. ``rate``: the one-row daily rate.
    """
    def raw(keys: tuple[str, ...]) -> Column:
        return P.meta_value(F.col("meta"), keys)

    numbers = products.withColumn("rate", rate.select("rate").scalar()).filter(F.col("rate").isNotNull()).select(
        "id",
        "sku",
        "name",
        "rate",
        T.strip(raw(P.meta_keys(K.MODE_KEYS, namespace))).alias("mode"),
        P.meta_number(raw(K.WEIGHT_KEYS)).alias("weight"),
        P.meta_number(raw(K.STONE_VALUE_KEYS)).alias("stone"),
        P.meta_number(raw(K.LEGACY_PRICE_KEYS)).alias("legacy"),
        P.meta_number(F.col("regular_price")).alias("old"),
    )
    parsed = computed(
        numbers,
        weight=P.positive(F.col("weight")),
        stone=P.nonnegative_whole(F.col("stone")),
        legacy=P.nonnegative_whole(F.col("legacy")),
        old_price=P.whole_or_zero(F.col("old")),
    )
    priced = computed(
        parsed.withColumn("reason", price_reason(F.col("mode"), F.col("weight"), F.col("stone"), F.col("legacy"))),
        new_price=mode_price(F.col("reason"), F.col("weight"), F.col("stone"), F.col("legacy"), F.col("rate")),
    )
    return priced.select(
        "id",
        "sku",
        "name",
        "old_price",
        "new_price",
        "reason",
        delta_percent(F.col("old_price"), F.col("new_price")).alias("delta_pct"),
        "rate",
    )


def changes(preview: DataFrame) -> DataFrame:
    return preview.filter(F.col("new_price").isNotNull() & (F.col("new_price") != F.col("old_price")))


def reason_counts(preview: DataFrame) -> DataFrame:
    return preview.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).withColumn("skipped", F.col("reason").startswith("skip"))


def top_changes(preview: DataFrame, top: int = 20) -> DataFrame:
    """Largest relative moves; ties go by id."""
    return (
        preview.filter(F.col("new_price").isNotNull())
        .orderBy(F.desc(F.abs("delta_pct")), F.asc("id"))
        .limit(top)
    )


def audit_rows(preview: DataFrame) -> DataFrame:
    """Before-image of every price about to change."""
    return changes(preview).select(
        "id",
        "sku",
        F.col("old_price").alias("old_regular_price"),
        F.col("new_price").alias("new_regular_price"),
        F.col("reason").alias("mode"),
        "rate",
    )
