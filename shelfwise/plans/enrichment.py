"""Enrich existing drafts from the catalog sheet and stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import enrich as E, pages as W, selection as S, upsert as U
from shelfwise.session import cut_lineage


def plan(drafts: DataFrame, cells: DataFrame, pages: DataFrame, shop: str, title_fallback: str = "محصول نقره") -> tuple[DataFrame, DataFrame]:
    """(reconciled drafts, drafts without a sheet row).

    ``drafts``: product_id, legacy_id, public_title, legacy_original_title, sku, price. A page belongs to the
    product id in its address; of several pages the one with the lowest ``page_id`` counts.
    """
    records = S.priced_records(cells, title_fallback)
    matched, missing = E.split_drafts(drafts, records)
    owned = W.may_have_specs(pages).withColumn("legacy_id", W.U.product_id_in_path(F.col("url"))).filter("legacy_id is not null")
    # pages of products no draft asks for are not walked
    owned = owned.join(drafts.select(F.col("legacy_id").cast("bigint").alias("legacy_id")).distinct(), "legacy_id", "left_semi")
    specs = W.best_specs(W.spec_rows(W.walk_pages(owned)))
    first = specs.join(owned.select("page_id", "legacy_id"), "page_id").groupBy("legacy_id").agg(
        F.min_by(F.struct(*[c for c in specs.columns if c != "page_id"]), "page_id").alias("s")
    )
    base = E.enrichment_plan(matched, title_fallback).withColumn("sku", F.col("current_sku"))
    done = E.reconcile(E.with_specs(base, first.select("legacy_id", "s.*"), "legacy_id", ["product_id"], counted=drafts), shop)
    return (
        done.withColumn("update_price", E.price_update_needed(F.col("price_reconciled"), F.col("final_price"), F.col("current_price")))
        .withColumn("specs_found_count", F.coalesce(F.size("spec_map"), F.lit(0)))
        .withColumn("action", F.lit("ENRICHED_DRAFT")),
        missing,
    )


def apply(store: DataFrame, planned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(updated drafts, violations). The plan is written once, so both frames see the same rows."""
    return U.targeted_updates(store, cut_lineage(planned))
