"""Legacy feed to store payloads and the mapping table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.operators import upsert as U
from shelfwise.sources.keyed import KeyedTable


def plan(feed: DataFrame, mapping: DataFrame, synced_at: str, prefix: str = K.SKU_PREFIX) -> tuple[DataFrame, DataFrame]:
    """(payloads, mapping after the sync). A known product id stays; new rows get theirs when the store has created them."""
    items = U.sync_items(feed, mapping, synced_at, prefix)
    incoming = U.mapping_rows(items, F.col("known_product"))
    return U.payloads(items), U.upsert(mapping, incoming, "legacy_id")


def apply(feed: DataFrame, mapping: KeyedTable, synced_at: str, prefix: str = K.SKU_PREFIX) -> tuple[DataFrame, list[int]]:
    """Sync into a keyed mapping table: only buckets of the feed's items are read, only changed rows written."""
    items = U.sync_items(feed, mapping.lookup(feed), synced_at, prefix)
    return U.sync_into(mapping, U.mapping_rows(items, F.col("known_product")))
