"""Daily repricing: plan a price per product, show the effect, then write audit and new prices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfwise import constants as K
from shelfwise.functions.parsing import meta_keys
from shelfwise.operators import repricing as R
from shelfwise.operators.upsert import apply_prices, apply_prices_to
from shelfwise.sources.keyed import KeyedTable
from shelfwise.sources.reading import published_products
from shelfwise.sources.writing import commit_version, write_run


@dataclass
class Repricing:
    preview: DataFrame

    @property
    def changes(self) -> DataFrame:
        return R.changes(self.preview)

    @property
    def reasons(self) -> DataFrame:
        return R.reason_counts(self.preview)

    def top(self, size: int = 20) -> DataFrame:
        return R.top_changes(self.preview, size)

    @property
    def audit(self) -> DataFrame:
        return R.audit_rows(self.preview)


def plan(snapshot: DataFrame, rate: DataFrame, namespace: str | None = None) -> Repricing:
    """Lazy plan over the published products of a store snapshot."""
    keys = (
        meta_keys(K.MODE_KEYS, namespace)
        + K.WEIGHT_KEYS
        + K.STONE_VALUE_KEYS
        + K.LEGACY_PRICE_KEYS
        + K.MANUAL_PRICE_KEYS
    )
    return Repricing(R.reprice(published_products(snapshot, keys), rate, namespace))


def apply(store: DataFrame, planned: Repricing, audit_root: str, table_root: str, stamp: str) -> DataFrame:
    """Audit first, then a new table version. Returns the audit rows whose product no longer exists.

    The audit is written and read back, so table and audit hold the same prices whatever is recomputed later.
    """
    write_run(planned.audit, audit_root, stamp)
    audit = store.sparkSession.read.parquet(f"{audit_root}/run_stamp={stamp}")
    updated, gone = apply_prices(store, audit)
    commit_version(updated, table_root)
    return gone


def apply_to(table: KeyedTable, planned: Repricing, audit_root: str, stamp: str) -> tuple[DataFrame, list[int]]:
    """Audit first, then the changed prices into a keyed table; gives the audit rows whose product is gone and the buckets written."""
    write_run(planned.audit, audit_root, stamp)
    return apply_prices_to(table, table.spark.read.parquet(f"{audit_root}/run_stamp={stamp}"))
