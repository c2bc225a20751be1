import pytest
from pyspark.sql import functions as F

from shelfwise.functions.pricing import WARN_CONFIDENCE, difference_flag
from shelfwise.operators.audit import anomaly_counts, anomaly_report, anomaly_rows
from shelfwise.operators.prepared import with_safe_price
from shelfwise.operators.repricing import reprice
from shelfwise.plans import repricing as plan
from shelfwise.sources import reading, writing

META = "id bigint, sku string, name string, status string, regular_price string, sale_price string, meta map<string,string>"
PRODUCTS = [
    (1, "A", "a", "publish", "500000", "9", {"pricing_mode": "silver_weight_only", "silver_weight_grams": "6.80"}),
    (2, "B", "b", "publish", "1,000", None, {"shop_pricing_mode": "silver_weight_plus_stone", "_silver_weight_g": "5.0", "_stone_fixed_value_toman": "200,000"}),
    (3, "C", "c", "publish", "7", None, {"pricing_mode": "manual_locked"}),
    (4, "D", "d", "publish", "300000", None, {"pricing_mode": "legacy_mirror", "legacy_price_toman": "300000"}),
    (5, "E", "e", "publish", "", None, {}),
    (6, "F", "f", "draft", "1", None, {"pricing_mode": "legacy_mirror", "legacy_price_toman": "5"}),
    (7, "G", "g", "publish", "x", None, {"pricing_mode": "silver_weight_only", "silver_weight_grams": "NaN"}),
]


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(PRODUCTS, META)


def rate(spark, value="85,000"):
    return reading.daily_rate(spark.createDataFrame([(value,)], "value string"))


def test_four_modes(spark, store):
    planned = plan.plan(store, rate(spark), "shop")
    got = {r.id: (r.new_price, r.reason) for r in planned.preview.collect()}
    assert got == {
        1: (580_000, "calc-weight"), 2: (625_000, "calc-weight-stone"), 3: (None, "skip-manual-locked"),
        4: (300_000, "mirror-legacy"), 5: (None, "skip-missing-mode"), 7: (None, "skip-missing-or-bad-weight"),
    }
    assert sorted(r.id for r in planned.changes.collect()) == [1, 2]
    assert [r.id for r in planned.top(1).collect()] == [2]


def test_apply_writes_audit_first_and_is_idempotent(spark, store, tmp_path):
    planned = plan.plan(store, rate(spark), "shop")
    gone = plan.apply(store, planned, f"{tmp_path}/audit", f"{tmp_path}/table", "20240101")
    assert gone.count() == 0
    audit = spark.read.parquet(f"{tmp_path}/audit")
    assert {(r.id, r.old_regular_price, r.new_regular_price) for r in audit.collect()} == {(1, 500_000, 580_000), (2, 1_000, 625_000)}
    current = writing.read_current(spark, f"{tmp_path}/table")
    after = {r.id: (r.regular_price, r.sale_price) for r in current.collect()}
    assert after[1] == ("580000", None) and after[4] == ("300000", None) and len(after) == len(PRODUCTS)
    assert plan.plan(current, rate(spark), "shop").changes.count() == 0


@pytest.mark.parametrize("text", ["0", "12.5", "", "-4"])
def test_bad_rate_fails(spark, text):
    with pytest.raises(Exception, match="daily rate"):
        rate(spark, text).collect()


@pytest.mark.parametrize(
    "row, expected",
    [
        (("rings", "large_stone", "0.85", "10", "5,000,000"), (590_000, "large_stone", 5_900_000, 5_900_000, "CALCULATED_FLOOR_HIGHER", False)),
        (("rings", "large_stone", "0.849", "10", "5,000,000"), (650_000, "uncertain", 6_500_000, 6_500_000, "CALCULATED_FLOOR_HIGHER", True)),
        (("necklaces", "large_stone", "0.99", "10", "7,001,000"), (650_000, "not_applicable", 6_500_000, 7_050_000, "LEGACY_PRICE_HIGHER", False)),
        (("rings", "no_stone", "1", "", "7,001,000"), (650_000, "no_stone", None, 7_050_000, "WEIGHT_MISSING_USED_LEGACY_REVIEW", True)),
        (("watches", "", "", "bad", ""), (650_000, "uncertain", None, None, "INVALID_DATA_REVIEW", True)),
    ],
)
def test_safe_price(spark, row, expected):
    frame = spark.createDataFrame([row], "category string, stone string, confidence string, weight string, legacy string")
    p = with_safe_price(frame, "category", "stone", "confidence", "weight", "legacy").first().price
    assert (p.rate, p.effective_class, p.calculated_price, p.final_price, p.reason, p.review) == expected
    assert (WARN_CONFIDENCE in p.warnings) == (row[2] == "0.849")


def test_difference_flag(spark):
    rows = spark.createDataFrame([(130, 100), (129, 100), (100, 130), (None, 1)], "a bigint, b bigint")
    flags = [r[0] for r in rows.select(difference_flag(F.col("a"), F.col("b"))).collect()]
    assert [f and f.split()[3] for f in flags] == ["above", None, "below", None]


def test_anomalies(spark):
    w, s = {"pricing_mode": "silver_weight_only", "silver_weight_grams": "5"}, "silver_weight_plus_stone"
    rows = [
        (1, "A", "ok", True, 3, "visible", w), (2, "B", "zero", True, 0, "visible", w), (3, "C", "neg", True, -1, "visible", w),
        (4, "D", "nw", True, 1, "visible", {"pricing_mode": "silver_weight_only"}), (5, "E", "ns", True, 1, "visible", {"pricing_mode": s, "weight_grams": "2"}),
        (6, "F", "nm", False, None, "visible", w), (7, "G", "first", True, 1, "visible", {}), (8, "G", "again", True, 1, "visible", {}),
        (9, "", "x", True, 1, "visible", {}), (10, "", "y", True, 1, "visible", {}),
    ]
    found = anomaly_rows(spark.createDataFrame(rows, "id bigint, sku string, name string, manage_stock boolean, stock_quantity bigint, catalog_visibility string, meta map<string,string>"))
    assert {(r.label, r.id) for r in found.collect()} == {
        ("zero_visible", 2), ("negative_stock", 3), ("missing_weight_meta", 4), ("missing_stone_value", 5), ("mode_no_manage_stock", 6), ("duplicate_sku", 8)}
    assert anomaly_counts(found).count() == 6
    assert anomaly_report(found.unionByName(found.withColumn("id", F.col("id") + 100)), 1).filter("more = 1").count() == 6
