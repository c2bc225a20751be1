"""Catalog sheet to store drafts: price, select, find pages, reconcile, decide, create."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import enrich as E, importing as M, pages as W, selection as S
from shelfwise.session import cut_lineage


def select(cells: DataFrame, limit: int, title_fallback: str = "محصول نقره") -> tuple[DataFrame, DataFrame]:
    """(planned records, selection summary). The few selected records are written once; every later step reads them."""
    records = S.priced_records(cells, title_fallback)
    return cut_lineage(S.select_newest(records, limit)), S.selection_summary(records, limit)


def attach_pages(
    planned: DataFrame, pages: DataFrame, base_url: str, site_host: str, shop: str, site_search: DataFrame | None = None, sitemap: DataFrame | None = None
) -> DataFrame:
    """Planned records with page address, images and reconciled specifications. Skipped records fetch nothing.

    A record's page is sought at its direct addresses, then among the ``site_search`` results, then in the ``sitemap``
    (legacy_id, position, target each). Only pages at one of these addresses are walked, once; the walked rows feed both
    images and specifications. The batch, the assets and the result are written once each, because several joins and
    reports read them.
    """
    planned = cut_lineage(planned)
    skipped = F.coalesce(F.col("action"), F.lit("")).startswith("SKIP_")
    wanted = planned.filter(~skipped)
    candidates = W.direct_candidates(wanted, base_url)
    for rank, found in ((2, site_search), (3, sitemap)):
        if found is not None:
            asked = found.join(wanted.select("legacy_id").distinct(), "legacy_id", "left_semi")
            candidates = candidates.unionByName(asked.select("legacy_id", F.lit(rank).alias("strategy_rank"), F.col("position").cast("int").alias("position"), "target"))
    candidates = cut_lineage(candidates)
    addressed = pages.join(candidates.select(F.col("target").alias("url")).distinct(), "url", "left_semi")
    walked = cut_lineage(W.walk_pages(addressed))
    specs = W.best_specs(W.spec_rows(walked))
    images = walked.select("page_id", "url", W.gallery_urls(F.col("gallery"), F.col("gallery_marked"), site_host).alias("image_urls"))
    assets = cut_lineage(images.join(specs, "page_id", "left").filter((F.size("image_urls") > 0) | F.col("specs").isNotNull()))
    located = cut_lineage(W.discover(wanted, candidates, assets))
    by_url = assets.dropDuplicates(["url"]).withColumnRenamed("url", "legacy_url")
    specified = E.with_specs(located, by_url.filter("specs is not null"), "legacy_url", ["row_no"])
    reconciled = E.reconcile(specified, shop)
    pictured = reconciled.join(by_url.select("legacy_url", "image_urls"), "legacy_url", "left")
    has_images = F.coalesce(F.size("image_urls"), F.lit(0)) > 0
    attached = pictured.withColumns(
        {
            "image_status": F.when(has_images, "READY").otherwise("MISSING"),
            "review_flags": F.when(has_images, F.col("review_flags")).otherwise(
                F.array_distinct(F.concat("review_flags", F.array(F.lit("IMAGES_MISSING"))))
            ),
            "requires_review": F.when(has_images, F.col("requires_review")).otherwise("YES"),
            "action": F.when(F.col("action") == "PLAN_CREATE_DRAFT", "READY_DRAFT").otherwise(F.col("action")),
        }
    )
    rest = planned.filter(skipped).withColumn("image_status", F.lit("SKIPPED"))
    return cut_lineage(attached.unionByName(rest, allowMissingColumns=True))


def decide(planned: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decisions, legacy ids claimed by several store products). ``store``: product_id, sku, meta."""
    by_id, clashes = M.alias_lookup(M.alias_ids(store))
    records = planned.withColumn("legacy_id", F.col("legacy_id").cast("string"))
    return M.import_decisions(records, by_id, store.select("sku", "product_id")), clashes
