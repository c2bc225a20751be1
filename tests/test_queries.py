"""A cross-section of the registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = (
    "reprice_preview", "catalog_rows", "profile_totals", "taxonomy_tree", "catalog_price_plan", "select_newest", "import_decisions",
    "alias_key_clashes", "protected_payload", "merge_products", "anomaly_top_per_bucket", "first_wins_line", "round_robin", "order_alert_text",
    "stream_new_orders", "page_product_fields", "page_links", "doc_public_section", "safe_price", "prepared_products", "media_rollup", "resize_plan",
)


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables are absent")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, engine, name):
    assert compare(spark, engine, FOLDER, name).startswith("ok")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    from shelfwise.registry import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables are absent")
def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
