from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.operators import profile as P, selection as S
from shelfwise.plans import profile as plan
from shelfwise.sources import reading

SHEET = [
    (2, "1", "a", "انگشتر عقیق مردانه", "100000", "موجود", "1", "5.5"),
    (3, "2", "b", "انگشتر عقیق مردانه", "۲۰۰٬۰۰۰ تومان", "موجود", "1", None),
    (4, "3", "c", "گردنبند فیروزه زنانه", "300000", "ناموجود", "1", "7,25 گرم"),
    (5, "4", "d", "دستبند حدید مردانه", "400000", "موجود", "0", "8"),
    (6, "3000", "e", "انگشتر عقیق مردانه", "500000", "ناموجود", "1", None),
    (7, "3001", "f", "گردنبند فیروزه زنانه", None, "موجود", "0", "نامشخص"),
    (8, "3642", "g", "دستبند حدید مردانه", "800000", "موجود", "1", "10"),
    (9, "3643", "h", None, "900000", "ناموجود", "0", None),
    (10, None, " ", "-", None, None, "", None),
]
CELLS = "row_no bigint, id_cell string, title_cell string, category_cell string, price_cell string, availability_cell string, active_cell string, weight_cell string"


@pytest.fixture(scope="module")
def report(spark):
    return plan.run(spark.createDataFrame(SHEET, CELLS))


def test_totals(report):
    t = report["totals"].first()
    assert (t.total_rows, t.category_count, t.missing_category, t.id_min, t.id_max) == (8, 3, 1, 1, 3643)
    assert (t.weight_present, t.weight_missing, t.weight_valid, t.weight_present_invalid, float(t.weight_coverage)) == (5, 3, 4, 1, 62.5)
    assert (t.price_count, t.price_missing, int(t.price_min), int(t.price_max)) == (7, 1, 100000, 900000)
    assert (t.active, t.inactive, t.unknown) == (5, 3, 0)


def test_categories_and_taxonomy(report):
    ranked = [(r["rank"], r.category, r.n) for r in report["categories"].orderBy("rank").collect()]
    assert ranked == [(1, "انگشتر عقیق مردانه", 3), (2, "دستبند حدید مردانه", 2), (3, "گردنبند فیروزه زنانه", 2)]
    assert {r.availability: r.n for r in report["availability"].collect()} == {"موجود": 5, "ناموجود": 3}
    tree = {(r.parent, r.child): r.n for r in report["tree"].collect()}
    assert tree[("انگشتر", "مردانه")] == 3 and tree[("انگشتر", None)] == 3 and tree[("گردنبند و آویز", "گردنبند")] == 2
    gems = {r.pattern: (r.category_count, r.product_count) for r in report["gemstones"].collect()}
    assert gems["عقیق"] == (1, 3) and gems["زمرد"] == (0, 0) and len(gems) == len(K.GEMSTONE_PATTERNS)


def test_windows_keep_both_ends(spark):
    rows = P.valid_rows(P.catalog_rows(spark.createDataFrame(SHEET, CELLS)))
    ends = P.id_windows(rows, 5).collect()
    assert [r.legacy_id for r in ends if r.window == "lowest"] == [1, 2, 3, 4, 3000]
    assert [r.legacy_id for r in ends if r.window == "highest"] == [3643, 3642, 3001, 3000, 4]


def test_rank_does_not_depend_on_partitions(spark):
    counts = spark.range(500).select((F.col("id") % 7).alias("n"), F.concat(F.lit("c"), F.col("id")).alias("category"))
    expected = sorted(((r.n, r.category) for r in counts.collect()), key=lambda x: (-x[0], x[1]))
    for parts in (1, 5):
        from shelfwise.operators.keys import dense_order

        got = dense_order(counts, [F.desc("n"), F.asc("category")], "rank", parts).orderBy("rank").collect()
        assert [(r.n, r.category) for r in got] == expected and [r["rank"] for r in got] == list(range(1, 501))


IMPORT = [
    ("۳۶۴۳", "انگشتر نقره کد 1058", "انگشتر های خطی", "۷٬۶۸۹٬۰۰۰", "۲", "۱", "محدود", None, "2079000.0000000002"),
    ("3642", "گردنبند فیروزه", "مدال نقره", "2079000", "1", "1", "محدود", "2", "2079000.0000000002"),
    ("3641", "دستبند نقره", "دستبند مردانه", "1000000", "3", "1", "محدود", "۱٫۰", "۱۰۵۹"),
    ("3640", "انگشتر با نگین درشت عقیق", "انگشتر عقیق", "5000000", "1", "1", "محدود", "10", "999"),
    ("3639", "انگشتر بدون وزن", "انگشتر زنانه", "7689000", "4", "1", "محدود", None, None),
    ("3638", "محصول غیرفعال", "انگشتر", "1000000", "1", "0", "محدود", "1", "88"),
    ("3637", "محصول ناموجود", "دستبند", "1000000", "0", "1", "ناموجود", "1", "89"),
    ("3636", "محصول دسته ناشناخته", "سایر زیورآلات", "1000000", "5.7", "1", "محدود", "2", "قیمت 1000000"),
]


@pytest.fixture(scope="module")
def records(spark):
    columns = "id_cell string, title_cell string, category_cell string, price_cell string, stock_cell string, active_cell string, availability_cell string, weight_cell string, code_cell string"
    frame = spark.createDataFrame(IMPORT, columns).repartition(3).withColumn("row_no", 4000 - F.regexp_extract(F.translate("id_cell", K.PERSIAN_DIGITS, K.ASCII_DIGITS), "[0-9]+", 0).cast("bigint"))
    empty = F.lit(None).cast("string")
    return S.priced_records(frame.withColumn("pre_discount_cell", empty).withColumn("seo_title_cell", empty).withColumn("seo_description_cell", empty)).cache()


def test_golden_records(records):
    r = {x.legacy_id: x for x in records.collect()}
    assert (r[3643].sku, r[3643].sku_source, r[3643].title, r[3643].identity_key) == ("1058", "TITLE_CODE", "انگشتر نقره", "3643:1058")
    assert (r[3643].price_source, r[3643].final_price) == ("EXCEL_ONLY", 7_700_000)
    assert (r[3642].sku, r[3642].category, r[3642].computed_price, r[3642].price_source, r[3642].final_price) == ("NM-3642", "necklaces", 1_300_000, "MAX_EXCEL", 2_100_000)
    assert (r[3641].sku, r[3641].sku_source, r[3641].category, r[3641].price_source, r[3641].final_price) == ("1059", "COL27_VALIDATED", "bracelets", "MAX_EXCEL", 1_000_000)
    assert (r[3640].stone_class, r[3640].rate_used, r[3640].price_source, r[3640].final_price) == ("large_stone", 590_000, "MAX_CALCULATED", 5_900_000)
    assert (r[3639].sku, r[3639].final_price) == ("NM-3639", 7_700_000)
    assert (r[3636].stock, r[3636].final_price) == (5, 1_300_000)
    assert r[3636].review_flags == ["STOCK_FRACTION_FLOORED", "UNKNOWN_CATEGORY_DEFAULTED_TO_RINGS"]
    assert all(x.regular_price == x.final_price and (x.final_price or 0) % 50_000 == 0 for x in r.values())


def test_selection(records):
    chosen = S.select_newest(records, 4).orderBy(F.desc("legacy_id")).collect()
    assert [x.legacy_id for x in chosen] == [3643, 3642, 3641, 3640] and {x.action for x in chosen} == {"PLAN_CREATE_DRAFT"}
    assert tuple(S.selection_summary(records, 4).first()) == (8, 1, 1, 6, 4)
    assert S.select_newest(records, 1000).count() == 6
    assert S.preview(records.filter("eligible").limit(6), 2).first().remaining == 4
    assert S.select_newest(records, 5000).count() == 6
    with pytest.raises(ValueError):
        S.select_newest(records, 0)


def test_first_claim_wins_even_when_skipped(spark, records):
    twice = records.filter("legacy_id = 3642").withColumn("sku", F.lit("NM-3641")).withColumn("row_no", F.lit(99999).cast("bigint"))
    third = records.filter("legacy_id = 3641").withColumn("sku", F.lit("nm-3641"))
    both = records.filter("legacy_id = 3642").unionByName(twice).unionByName(third)
    actions = [x.action for x in S.select_newest(both, 10).orderBy(F.desc("legacy_id"), "row_no").collect()]
    assert actions == ["PLAN_CREATE_DRAFT", "SKIP_DUPLICATE_BATCH_LEGACY_ID", "SKIP_DUPLICATE_BATCH_SKU"]


def test_positional_source(spark, tmp_path):
    headers = [f"h{i}" for i in range(1, 30)]
    headers[0], headers[6] = "﻿id", "نام محصول"
    line = [f"v{i}" for i in range(1, 30)]
    (tmp_path / "sheet.csv").write_text(",".join(headers) + "\n" + ",".join(line) + "\n", encoding="utf-8")
    sheet = reading.read_sheet_csv(spark, str(tmp_path / "sheet.csv"))
    assert sheet.columns[0] == "id"
    row = reading.catalog_cells(sheet, min_columns=29).first()
    assert (row.id_cell, row.title_cell, row.category_cell, row.weight_cell, row.code_cell, row.seo_description_cell) == ("v1", "v7", "v5", "v22", "v27", "v29")
    assert reading.resolve_title_column(["x", "y"]) == 2 and reading.resolve_title_column(["a", "b", "عنوان کامل"]) == 3
    with pytest.raises(ValueError):
        reading.catalog_cells(sheet.select(*sheet.columns[:10]))


def test_pages_join_the_import_and_decisions_follow(spark, records):
    from shelfwise.operators.prepared import SHEET_REPORT, report, sheet_summary
    from shelfwise.plans import catalog_import as CI

    planned = S.select_newest(records, 4)
    site = "shop.example.com"
    spec = "<h2>مشخصات</h2><p>وزن: ۱۶ گرم · نوع سنگ: حدید</p>"
    pages = spark.createDataFrame(
        [(1, f"https://{site}/product/3643/", spec + '<img src="/product-images/a.jpg">'), (2, f"https://{site}/p/3642/", '<img src="/uploads/b.png">'), (3, f"https://{site}/product/3641/", "nothing")],
        "page_id bigint, url string, html string")
    done = CI.attach_pages(planned, pages, f"https://{site}", site, "فروشگاه")
    got = {r.legacy_id: r for r in done.collect()}
    assert (got[3643].final_price, got[3643].strategy, got[3643].image_status, got[3643].action) == (10_400_000, "DIRECT_ID_PATTERN", "READY", "READY_DRAFT")
    assert got[3642].image_urls == [f"https://{site}/uploads/b.png"] and got[3642].description_source == "SEO_FALLBACK"
    assert (got[3641].strategy, got[3641].image_status) == ("NOT_FOUND", "MISSING") and "IMAGES_MISSING" in got[3641].review_flags
    store = spark.createDataFrame([(7, "x", {"legacy_id": "3643"}), (8, "NM-3642", {})], "product_id bigint, sku string, meta map<string,string>")
    decided, clashes = CI.decide(done, store)
    assert {r.legacy_id: r.decision for r in decided.collect()} == {"3643": "SKIP_EXISTING_LEGACY_ID", "3642": "SKIP_SKU_CONFLICT", "3641": "CREATE_DRAFT", "3640": "CREATE_DRAFT"}
    assert clashes.count() == 0
    lines = report(done, SHEET_REPORT).collect()
    assert len(lines[0].asDict()) == 45 and {r.final_price_toman for r in lines if r.legacy_id == "3643"} == {"10400000"}
    assert sheet_summary(done).first().missing_images == 2


def test_enrichment_updates_price_once(spark, records):
    from shelfwise.plans import enrichment as EN

    columns = "row_no bigint, id_cell string, title_cell string, category_cell string, price_cell string, pre_discount_cell string, stock_cell string, availability_cell string, active_cell string, weight_cell string, code_cell string, seo_title_cell string, seo_description_cell string"
    cells = spark.createDataFrame([(2, "3643", "انگشتر نقره کد 1058", "انگشتر", "7689000", None, "2", "1", "1", None, None, None, None)], columns)
    drafts = spark.createDataFrame([(1, 3643, "انگشتر", "", "1058", 7_700_000), (2, 9, "x", "", "", 5)], "product_id bigint, legacy_id bigint, public_title string, legacy_original_title string, sku string, price bigint")
    pages = spark.createDataFrame([(1, "https://h/product/3643/", "<h2>مشخصات</h2><p>وزن: ۱۶ گرم</p>")], "page_id bigint, url string, html string")
    planned, missing = EN.plan(drafts, cells, pages, "فروشگاه")
    assert [r.product_id for r in missing.collect()] == [2]
    store = spark.createDataFrame([(1, 3643, "draft", "t", "", 7_700_000)], "product_id bigint, legacy_id bigint, status string, title string, description string, regular_price bigint")
    updated, violations = EN.apply(store, planned)
    after = updated.first()
    assert (after.regular_price, after.title) == (10_400_000, "انگشتر نقره") and violations.count() == 0
    again, _ = EN.plan(drafts.withColumn("price", F.lit(10_400_000).cast("bigint")), cells, pages, "فروشگاه")
    assert again.first().update_price is False


def test_one_sheet_file_is_priced_by_many_tasks(spark, tmp_path):
    from shelfwise.queries import views as V

    parts = spark.range(4000).selectExpr("id AS p_partkey", "concat('نقره ', id) AS p_name", "'Brand#11' AS p_brand", "CAST(id % 50 AS INT) AS p_size")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))  # one file of one row group
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        priced = S.priced_records(V.sheet(spark, str(tmp_path)))
        sizes = [r["count"] for r in priced.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    wanted = sum(i > 0 and i % 97 != 5 and not (i == 1 and i % 41 == 7) for i in range(4000))
    assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes) and sum(sizes) == wanted


def test_latest_row_carries_only_the_columns_asked_for(spark):
    from shelfwise.operators import enrich as E

    rows = [(1, 5, "a", None, "s5"), (1, 7, None, 70, "s7"), (1, 6, "c", 60, "s6"), (2, 1, "d", None, None)]
    sheet = spark.createDataFrame(rows, "legacy_id bigint, row_no bigint, title string, final_price bigint, seo_title string").repartition(3)
    latest = E.latest_by_id(sheet)
    assert {tuple(r) for r in latest.select("legacy_id", "row_no", "title", "final_price", "seo_title").collect()} == {(1, 7, None, 70, "s7"), (2, 1, "d", None, None)}
    drafts = spark.createDataFrame([(11, 1), (12, 3)], "product_id bigint, legacy_id bigint")
    matched, missing = E.split_drafts(drafts, sheet)
    assert [tuple(r) for r in matched.select("product_id", "sheet_final_price").collect()] == [(11, 70)] and missing.first().product_id == 12
    plan = latest.select("legacy_id", "final_price")._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by(final_price" in plan and "max_by(seo_title" not in plan and "max_by(struct" not in plan
