"""Inventory anomaly audit and store invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import parsing as P, text as T
from shelfwise.operators.keys import mark_repeats, top_per_group


def _number(value: Column) -> Column:
    return F.replace(value, F.lit(","), F.lit("")).try_cast("double")


def anomalies(products: DataFrame, namespace: str | None = None) -> DataFrame:
    """Products with their ``labels`` (six findings; a product may have several).

    ``products``: id, sku, name, manage_stock, stock_quantity, catalog_visibility, meta.
    """
    marked = mark_repeats(products, F.nullif(F.col("sku"), F.lit("")), ["id"], "repeat_sku")
    marked = (
        marked.withColumn("mode", T.strip(P.meta_value(F.col("meta"), P.meta_keys(K.MODE_KEYS, namespace))))
        .withColumn("weight", F.coalesce(_number(P.meta_value(F.col("meta"), K.WEIGHT_KEYS)), F.lit(0.0)))
        .withColumn("stone", F.coalesce(_number(P.meta_value(F.col("meta"), K.STONE_VALUE_KEYS)), F.lit(0.0)))
    )
    weighted = F.col("mode").isin(K.MODE_WEIGHT_ONLY, K.MODE_WEIGHT_PLUS_STONE)
    conditions = (
        F.col("manage_stock") & (F.col("stock_quantity") == 0) & (F.col("catalog_visibility") != "hidden"),
        F.col("stock_quantity") < 0,
        weighted & (F.col("weight") <= 0),
        (F.col("mode") == K.MODE_WEIGHT_PLUS_STONE) & (F.col("stone") < 1),
        weighted & ~F.col("manage_stock"),
        F.col("repeat_sku"),
    )
    labels = F.array_compact(F.array(*[F.when(c, label) for c, label in zip(conditions, K.ANOMALY_LABELS)]))
    return marked.withColumn("labels", labels).drop("repeat_sku", "mode", "weight", "stone")


def anomaly_rows(products: DataFrame, namespace: str | None = None) -> DataFrame:
    found = anomalies(products, namespace).filter(F.size("labels") > 0)
    return found.select(F.explode("labels").alias("label"), "id", "sku", "name", "stock_quantity")


def anomaly_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def anomaly_report(rows: DataFrame, size: int = 50) -> DataFrame:
    """First ``size`` products per finding with the number left out."""
    counts = anomaly_counts(rows)
    shown = top_per_group(rows, ["label"], [F.asc("id")], size)
    return (
        shown.join(F.broadcast(counts), "label")
        .withColumn("more", F.greatest(F.col("n") - size, F.lit(0)))
        .drop("n")
    )


def currency_violations(store: DataFrame, currency: str = K.CURRENCY) -> DataFrame:
    """Currencies in use other than the required one, with their row counts."""
    return store.filter(~F.col("currency").eqNullSafe(F.lit(currency))).groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


def single_price_violations(records: DataFrame) -> DataFrame:
    """Rows that expose more than one price: regular, current and final must agree, no sale price."""
    agree = F.col("regular_price").eqNullSafe(F.col("final_price")) & F.col("current_price").eqNullSafe(F.col("final_price"))
    return records.filter(~agree | F.col("sale_price").isNotNull())
