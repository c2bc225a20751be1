"""Keyed snapshots: upsert, field protection, create-only rows, targeted updates, metadata rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import text as T
from shelfwise.functions.classify import sync_pricing_mode, sync_stock
from shelfwise.functions.identity import shop_sku
from shelfwise.operators.keys import HOT_ROWS, lookup
from shelfwise.sources.keyed import KeyedTable


def last_per_key(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per non-null key: the last by ``order`` (ties and no order: the greatest row)."""
    names = [c for c in rows.columns if c != key]
    whole = [F.struct(*[F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in rows.dtypes if c != key])]
    rank = F.struct(*([F.col(order)] if order else []), *whole)
    last = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), rank).alias("__last"))
    return last.select(key, "__last.*").select(*rows.columns)


def upsert(current: DataFrame, incoming: DataFrame, key: str, keep: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """Full replacement by primary key; columns in ``keep`` stay as they are on existing rows.

    ``current`` holds one row per key. Of several incoming rows with one key the last by ``order`` is taken; without an order they
    are compared as a whole, so the result does not depend on how the rows arrive.
    """
    incoming = last_per_key(incoming, key, order)
    old = current.alias("old")
    new = incoming.alias("new")
    columns = [F.coalesce(F.col(f"new.{key}"), F.col(f"old.{key}")).alias(key)]
    for name in current.columns:
        if name == key:
            continue
        replaced = F.when(F.col(f"new.{key}").isNotNull(), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        if name in keep:
            replaced = F.coalesce(F.col(f"old.{name}"), F.col(f"new.{name}"))
        columns.append(replaced.alias(name))
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer").select(*columns)


def snapshot_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose row differs between two snapshots (empty after an idempotent re-run)."""
    names = [c for c in before.columns if c != key]
    old = before.select(key, F.struct(*names).alias("old_row"))
    new = after.select(key, F.struct(*names).alias("new_row"))
    return old.join(new, key, "full_outer").filter(~F.col("old_row").eqNullSafe(F.col("new_row"))).select(key)


def sync_items(feed: DataFrame, mapping: DataFrame, synced_at: str, prefix: str = K.SKU_PREFIX) -> DataFrame:
    """Feed items with mode, stock, SKU and whether the store row is protected (already published)."""
    known = mapping.select("legacy_id", F.col("wc_status").alias("known_status"), F.col("sku").alias("known_sku"), F.col("product_id").alias("known_product"))
    joined = feed.join(known, "legacy_id", "left")  # one row per id on both sides
    return joined.select(
        "legacy_id",
        T.persian_title(F.col("title")).alias("name"),
        shop_sku(F.col("cat_code"), F.col("gender_code"), F.col("legacy_id"), prefix).alias("sku"),
        sync_stock(F.col("stock")).alias("exact_stock"),
        sync_pricing_mode(F.col("weight_g"), F.col("is_special_gemstone"), F.col("stone_value"), F.col("price_locked")).alias(
            "pricing_mode"
        ),
        "weight_g",
        "price",
        F.substring_index("image_url", "?", 1).alias("image_src"),
        "known_status",
        "known_sku",
        "known_product",
        F.coalesce(F.col("known_status") == "publish", F.lit(False)).alias("protected"),
        F.lit(synced_at).alias("last_sync_utc"),
    )


def payloads(items: DataFrame) -> DataFrame:
    """Fields to write per item: stock only on protected rows, the full draft on the others."""
    open_row = ~F.col("protected")

    def draft(value: Column) -> Column:
        return F.when(open_row, value)

    return items.select(
        "legacy_id",
        F.lit(True).alias("manage_stock"),
        F.col("exact_stock").alias("stock_quantity"),
        draft(F.col("name")).alias("name"),
        draft(F.col("sku")).alias("sku"),
        draft(F.lit("draft")).alias("status"),
        draft(F.col("price")).alias("regular_price"),
        draft(F.col("pricing_mode")).alias("pricing_mode"),
        draft(F.col("image_src")).alias("image_src"),
    )


def mapping_rows(items: DataFrame, product_id: Column) -> DataFrame:
    """New mapping rows. A protected row keeps its published status and SKU."""
    return items.select(
        "legacy_id",
        F.when(F.col("protected"), F.col("known_sku")).otherwise(F.col("sku")).alias("sku"),
        product_id.alias("product_id"),
        F.when(F.col("protected"), F.col("known_status")).otherwise("draft").alias("wc_status"),
        "exact_stock",
        "pricing_mode",
        "last_sync_utc",
    )


def merge_meta(old: Column, new: Column) -> Column:
    """Existing metadata with new values; a new empty value deletes the key."""
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(kept, F.map_filter(new, lambda k, v: v != ""))


def present_meta(meta: Column) -> Column:
    return F.map_filter(meta, lambda k, v: v.isNotNull() & (v != ""))


def merge_products(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert by SKU: new rows are drafts, existing rows keep their status, categories are united; the last incoming row counts."""
    old, new = store.alias("old"), last_per_key(incoming, "sku").alias("new")
    joined = old.join(new, F.col("old.sku") == F.col("new.sku"), "full_outer")
    has_new, has_old = F.col("new.sku").isNotNull(), F.col("old.sku").isNotNull()

    def pick(name: str) -> Column:
        return F.when(has_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    no_meta = F.create_map().cast("map<string,string>")
    stock = F.when(has_new, F.col("new.stock")).otherwise(F.col("old.stock"))
    return joined.select(
        F.coalesce("new.sku", "old.sku").alias("sku"),
        pick("name"),
        F.when(has_old, F.col("old.status")).otherwise("draft").alias("status"),
        pick("price"),
        stock.alias("stock"),
        F.when(has_new, F.when(stock > 0, "instock").otherwise("outofstock")).otherwise(F.col("old.stock_status")).alias("stock_status"),
        F.when(has_new, F.array_union(F.coalesce("old.category_ids", F.array().cast("array<bigint>")), "new.category_ids"))
        .otherwise(F.col("old.category_ids"))
        .alias("category_ids"),
        merge_meta(F.coalesce("old.meta", no_meta), F.coalesce("new.meta", no_meta)).alias("meta"),
    )


def create_only(candidates: DataFrame, by_id: DataFrame, by_sku: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Candidates whose legacy id and SKU are both unknown to the store."""
    ids = by_id.select("legacy_id").distinct().withColumn("id_known", F.lit(True))
    skus = by_sku.select("sku").distinct().withColumn("sku_known", F.lit(True))
    marked = lookup(candidates, ids, "legacy_id", ["row_no"], hot_rows=hot_rows)
    marked = lookup(marked, skus, "sku", ["row_no"], hot_rows=hot_rows, counted=candidates)
    return marked.filter(F.col("id_known").isNull() & F.col("sku_known").isNull()).drop("id_known", "sku_known")


def targeted_updates(store: DataFrame, enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(drafts after the update, violations). Price changes only where ``update_price`` is set.

    A target must exist, be a draft and carry the same legacy id.
    """
    old = store.alias("old")
    new = enriched.alias("new")
    joined = old.join(new, F.col("old.product_id") == F.col("new.product_id"), "right")
    problem = (
        F.when(F.col("old.product_id").isNull() | (F.col("old.status") != "draft"), "DRAFT_NOT_FOUND")
        .when(~F.col("old.legacy_id").eqNullSafe(F.col("new.legacy_id")), "LEGACY_ID_MISMATCH")
    )
    checked = joined.withColumn("problem", problem)
    updated = checked.filter("problem is null").select(
        F.col("old.product_id").alias("product_id"),
        F.col("old.legacy_id").alias("legacy_id"),
        F.col("old.status").alias("status"),
        F.col("new.title").alias("title"),
        F.col("new.description").alias("description"),
        F.when(F.col("new.update_price"), F.col("new.regular_price")).otherwise(F.col("old.regular_price")).alias("regular_price"),
    )
    violations = checked.filter("problem is not null").select(
        F.col("new.product_id").alias("product_id"), F.col("new.legacy_id").alias("legacy_id"), "problem"
    )
    return updated, violations


def apply_prices(store: DataFrame, audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(store with new regular prices and no sale price, audit rows whose product is gone)."""
    new = audit.select("id", F.col("new_regular_price").cast("string").alias("__price"))
    updated = (
        store.join(new, "id", "left")
        .withColumn("regular_price", F.coalesce("__price", "regular_price"))
        .withColumn("sale_price", F.when(F.col("__price").isNull(), F.col("sale_price")))
        .drop("__price")
    )
    return updated, audit.join(store.select("id"), "id", "left_anti")


def apply_prices_to(table: KeyedTable, audit: DataFrame) -> tuple[DataFrame, list[int]]:
    """Set the prices of ``audit`` in a keyed store table; gives the audit rows whose product is gone and the buckets written."""
    gone = audit.join(table.lookup(audit), "id", "left_anti")
    _, touched = table.merge(audit, lambda held, new: apply_prices(held, new)[0])
    return gone, touched


def sync_into(mapping: KeyedTable, items: DataFrame) -> tuple[DataFrame, list[int]]:
    """Upsert mapping rows into the keyed mapping table; gives the changed rows and the buckets written."""
    return mapping.merge(items, lambda held, new: upsert(held, new, "legacy_id"))


def merge_products_into(store: KeyedTable, incoming: DataFrame) -> tuple[DataFrame, list[int]]:
    """``merge_products`` into a keyed store table; gives the changed rows and the buckets written."""
    return store.merge(incoming, merge_products)
