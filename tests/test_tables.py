import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dedup as D, importing as M, orders as O, prepared as Q, upsert as U
from shelfwise.operators.keys import lookup, mark_repeats, top_per_group
from shelfwise.operators.media import histogram_percentile, image_verdicts, media_rollup
from shelfwise.plans import csv_import, sync
from shelfwise.sources import reading, writing
from shelfwise.streaming import audits, orders as SO

COLUMNS = "row_number bigint, sku string, title_fa string, category string, weight_grams string, silver_purity string, stone_type string, stone_value_toman string, pricing_mode string, stock string, legacy_price_toman string, manual_price_toman string, short_description string, long_description string, image_filenames string"


def row(n, sku, category, mode, **more):
    base = dict(weight_grams="", silver_purity="925", stone_type="", stone_value_toman="", stock="", legacy_price_toman="", manual_price_toman="", image_filenames="")
    base.update(more)
    return (n, sku, "عنوان", category, base["weight_grams"], base["silver_purity"], base["stone_type"], base["stone_value_toman"], mode, base["stock"], base["legacy_price_toman"], base["manual_price_toman"], "s", "l", base["image_filenames"])


GOOD = [
    row(2, "SKU-RNG-U-1001", "rings", "silver_weight_only", weight_grams="6.80", image_filenames="a.jpg|b.png"),
    row(3, "SKU-NEC-W-1002", "necklaces", "silver_weight_plus_stone", weight_grams="۵٫۰", stone_type="عقیق", stone_value_toman="۲۰۰٬۰۰۰"),
    row(4, "SKU-BRC-M-1003", "bracelets", "legacy_mirror", legacy_price_toman="1500000"),
    row(5, "sku-rng-u-1004", "Rings", "manual_locked", manual_price_toman="2500000", stock="3"),
]


def test_import_plan(spark):
    store = spark.createDataFrame([("SKU-RNG-U-1004", 88)], "sku string, product_id bigint")
    files = spark.createDataFrame([("a.jpg",)], "image string")
    rate = spark.createDataFrame([(85000,)], "rate bigint")
    got = csv_import.plan(spark.createDataFrame(GOOD, COLUMNS), store, rate, files)
    rows = {r.row_number: r for r in got["rows"].collect()}
    assert [rows[i].price for i in (2, 3, 4, 5)] == [580_000, 625_000, 1_500_000, 2_500_000]
    assert [rows[i].action for i in (2, 3, 4, 5)] == ["CREATE", "CREATE", "CREATE", "UPDATE"] and rows[5].existing_id == 88
    assert [rows[i].stock_level for i in (2, 5)] == [1, 3] and got["errors"].count() == 0
    images = got["images"].first()
    assert (images.present_images, images.missing_images) == (["a.jpg"], ["b.png"])


def test_one_bad_row_refuses_the_batch(spark):
    bad = [row(6, "SAMPLE-1", "rings", "manual_locked"), row(7, "SKU-RNG-U-1001", "rings", "manual_locked", manual_price_toman="1"),
           row(8, "SKU-RNG-U-1009", "rings", "manual_locked", manual_price_toman="1", image_filenames="x.jpg|b.png|a.jpg"), row(9, "SKU-NEC-U-1010", "rings", "manual_locked"),
           row(10, "SKU-RNG-U-1011", "rings", "manual_locked", manual_price_toman="1", silver_purity="900"), row(11, "SKU-RNG-U-1012", "rings", "manual_locked", manual_price_toman="1", image_filenames="../x.jpg")]
    accepted, errors = M.batch_gate(M.validate_rows(spark.createDataFrame(GOOD + bad, COLUMNS).repartition(5), hot_rows=1))
    assert accepted.count() == 0
    assert {r.row_number: r.error for r in errors.collect()} == {
        6: "SAMPLE row detected; replace sample SKU/content before import", 7: "duplicate SKU in CSV: SKU-RNG-U-1001",
        8: "image filename(s) reused by another CSV row: b.png, a.jpg", 9: "SKU category code does not match category column",
        10: "silver_purity must equal 925", 11: M.IMAGE_MESSAGE}


def test_stop_all_decisions(spark):
    rows = spark.createDataFrame([(1, "10", "A", "CREATE_DRAFT"), (2, "11", "B", "CREATE_DRAFT"), (3, "12", "C", "SKIP_INVALID_REVIEW")], "row_no bigint, legacy_id string, sku string, import_action string")
    ids = spark.createDataFrame([("10", 5)], "legacy_id string, product_id bigint")
    none = spark.createDataFrame([], "sku string, product_id bigint")
    kept, blockers = M.stop_all_decisions(rows, ids, none)
    assert {(r.row_no, r.decision) for r in kept.collect()} == {(1, "SKIP_EXISTING_LEGACY_ID"), (2, "CREATE_DRAFT"), (3, "SKIP_INVALID_REVIEW")} and blockers.count() == 0
    kept, blockers = M.stop_all_decisions(rows, ids, spark.createDataFrame([("B", 9)], "sku string, product_id bigint"))
    assert kept.count() == 0 and blockers.first().decision == "STOP_SKU_CONFLICT"


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000])
def test_lookup_with_hot_and_null_keys(spark, hot_rows):
    rng = random.Random(5)
    left = [(i, None if i % 10 == 0 else ("hot" if i % 3 == 0 else f"k{rng.randrange(40)}")) for i in range(1500)]
    right = {"hot": 1, **{f"k{i}": i + 2 for i in range(0, 40, 2)}}
    frame = lookup(spark.createDataFrame(left, "id bigint, k string").repartition(7), spark.createDataFrame(list(right.items()), "k string, v bigint"), "k", ["id"], hot_rows=hot_rows)
    assert sorted((r.id, r.v) for r in frame.collect()) == sorted((i, right.get(k)) for i, k in left)


@pytest.mark.parametrize("parts", [1, 6])
def test_first_wins_is_independent_of_partitions(spark, parts):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    seen, want = set(), []
    for i, k in rows:
        want.append((i, k is not None and k in seen))
        seen.add(k)
    frame = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), "id bigint, k string").repartition(parts)
    assert sorted((r.id, r.again) for r in mark_repeats(frame, F.col("k"), ["id"], "again").collect()) == want


def test_top_per_group_cuts_before_the_shuffle(spark):
    frame = top_per_group(spark.range(100).withColumn("g", F.col("id") % 3), ["g"], [F.asc("id")], 2)
    text = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    assert text.count("WindowGroupLimit") == 2 and sorted(r.id for r in frame.collect()) == [0, 1, 2, 3, 4, 5]


def sequential(rows, limit=None):
    ids, codes, skus, out, kept = set(), {}, {}, {}, 0
    for order, i, code, sku in rows:
        if limit is not None and kept >= limit:
            break
        if code is None or sku is None:
            out[order] = ("MISSING_LEGACY_CODE", None)
        elif i in ids:
            out[order] = ("DUPLICATE_LEGACY_ID", None)
        elif code in codes:
            out[order] = ("DUPLICATE_LEGACY_CODE", str(codes[code]))
        elif sku in skus:
            out[order] = ("NORMALIZED_SKU_CONFLICT", str(skus[sku]))
        else:
            ids.add(i)
            codes[code], skus[sku] = i, i
            out[order] = (None, None)
            kept += 1
    return out


@pytest.mark.parametrize("seed, limit", [(1, None), (2, 7)])
def test_greedy_claims_equal_the_sequential_walk(spark, seed, limit):
    rng = random.Random(seed)
    rows = [(n, rng.randrange(25), rng.choice([None] + [f"c{x}" for x in range(20)]), f"s{rng.randrange(30)}") for n in range(120)]
    frame = spark.createDataFrame(rows, "n bigint, id bigint, code string, sku string").repartition(4)
    got = D.greedy_claims(frame, "n", "id", "code", "sku", limit, hot_rows=5)
    assert {r.n: (r.reason, r.conflicts_with) for r in got.collect()} == sequential(rows, limit)
    summary = D.run_summary(got, 1000).first()
    assert summary.incomplete_reason.startswith(f"only {summary.accepted} unique-code")


def test_round_robin_stops_at_a_round_boundary(spark):
    links = [(g, p, f"u{g}-{p}" if p else "same") for g, size in ((1, 5), (2, 2), (3, 9)) for p in range(size)]
    got = D.round_robin(spark.createDataFrame(links, "group_no int, position int, url string"), 7).orderBy("round_no", "group_no").collect()
    assert [r.url for r in got] == ["same", "u1-1", "u2-1", "u3-1", "u1-2", "u3-2"]


def test_sync_protects_published_rows_and_settles(spark):
    feed = spark.createDataFrame(
        [(1014, "انگشتر كد 1014", "78900000", 5, 6.8, False, 0, None, "RNG", "M", "https://i/x.jpg?size=1"), (1015, "t", "86900000", 2, 7.2, True, 500000, None, "RNG", "M", None), (1013, "t", "5", 1, 5.1, False, 0, None, "RNG", "M", None)],
        "legacy_id bigint, title string, price string, stock bigint, weight_g double, is_special_gemstone boolean, stone_value bigint, price_locked boolean, cat_code string, gender_code string, image_url string")
    mapping = spark.createDataFrame([(1014, "OLD", 5, "publish", 0, "x", "t")], "legacy_id bigint, sku string, product_id bigint, wc_status string, exact_stock bigint, pricing_mode string, last_sync_utc string")
    payloads, after = sync.plan(feed, mapping, "now")
    p = {r.legacy_id: r for r in payloads.collect()}
    assert (p[1014].name, p[1014].stock_quantity, p[1014].status) == (None, 5, None) and p[1015].status == "draft"
    modes = {r.legacy_id: (r.pricing_mode, r.exact_stock, r.wc_status, r.sku) for r in after.collect()}
    assert modes[1014] == ("silver_weight_only", 5, "publish", "OLD") and modes[1015][:3] == ("silver_weight_plus_stone", 2, "draft") and modes[1013][:2] == ("silver_weight_only", 1)
    again = sync.plan(feed, after, "now")[1]
    assert U.snapshot_changes(after, again, "legacy_id").count() == 0


def test_metadata_rules(spark):
    frame = spark.createDataFrame([({"a": "1", "b": "2"}, {"a": "", "c": "3"})], "old map<string,string>, new map<string,string>")
    got = frame.select(U.merge_meta(F.col("old"), F.col("new")).alias("m"), U.present_meta(F.col("new")).alias("p")).first()
    assert got.m == {"b": "2", "c": "3"} and got.p == {"c": "3"}


ORDER = "id bigint, status string, total string, currency string, shipping_city string, billing_city string, line_items array<struct<name:string,quantity:int>>"
ORDERS = [(100, "on-hold", "2490000", "IRT", "تهران", "", [("انگشتر", 1), ("دستبند", 2)]), (101, "processing", "5.5", "usd", "", "", None), (102, "pending", "1", "IRT", "", "", None)]


def test_alerts(spark):
    orders = spark.createDataFrame(ORDERS, ORDER)
    assert [r.id for r in O.new_orders(orders, 99).collect()] == [100, 101] and [r.id for r in O.new_orders(orders, 0, poll_limit=200, lookback=1).collect()] == [101]
    assert O.next_cursor(O.new_orders(orders, 99), 99).first()[0] == 101
    items = spark.createDataFrame([(101, p, f"n{p}", p) for p in range(1, 6)], "id bigint, position int, name string, quantity int")
    texts = {r.id: r.text for r in O.alerts(O.with_items(O.watched(orders), items)).collect()}
    assert texts[100] == "📦 سفارش جدید #۱۰۰\nوضعیت: در انتظار بررسی\nشهر: تهران\n• ۱× انگشتر\n• ۲× دستبند\nمبلغ: ۲,۴۹۰,۰۰۰ تومان"
    assert texts[101].splitlines()[3:] == ["• ۱× n1", "• ۲× n2", "• ۳× n3", "• و ۲ قلم دیگر", "مبلغ: ۵ تومان (usd)"] and "شهر: —" in texts[101]


def test_stream_alerts_each_order_once(spark, tmp_path):
    schema = spark.createDataFrame([], ORDER.split(", line_items")[0] + ", first_items array<struct<name:string,quantity:int>>, item_count bigint").schema
    source, outbox, progress = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress"

    def arrive(*rows):
        spark.createDataFrame([(i, s, "10", "IRT", "", "", [], 0) for i, s in rows], schema).write.mode("append").parquet(source)
        SO.start_alerts(SO.order_stream(spark, source, schema, "*.parquet"), outbox, progress).awaitTermination()
        return sorted(r.id for r in SO.read_outbox(spark, outbox).collect())

    assert arrive((5, "processing"), (4, "pending"), (5, "processing")) == [5]
    assert arrive((5, "on-hold"), (4, "processing")) == [4, 5]
    assert arrive((4, "processing")) == [4, 5]


def test_stream_repricing_uses_the_newest_rate(spark, tmp_path):
    products = spark.createDataFrame([(1, "A", "a", "1", {"pricing_mode": "silver_weight_only", "silver_weight_grams": "2"})], "id bigint, sku string, name string, regular_price string, meta map<string,string>")
    spark.createDataFrame([(50000, 1), (85000, 2)], "rate bigint, set_at bigint").write.parquet(f"{tmp_path}/rates")
    rates = spark.readStream.schema("rate bigint, set_at bigint").parquet(f"{tmp_path}/rates")
    audits.start_repricing(rates, lambda: products, f"{tmp_path}/changes", f"{tmp_path}/progress").awaitTermination()
    assert [r.new_price for r in spark.read.parquet(f"{tmp_path}/changes").collect()] == [170_000]


def test_media_rollup_and_histogram(spark):
    base = dict(mean_drift=1.0, p95_drift=1.0, channel_drift=1.0, detail_ratio=1.0, same_size=True, icc_lost=False, alpha_lost=False, checksum_changed=False)
    rows = [{"product_id": 1, "position": p, "original_path": f"o{p}", "processed_path": f"w{p}", **base, **({"mean_drift": 7.0, "icc_lost": True} if p == 2 else {})} for p in (1, 2)]
    verdicts = image_verdicts(spark.createDataFrame(rows))
    assert {r.position: (r.status, r.import_path, len(r.reasons)) for r in verdicts.collect()} == {1: ("PASS", "w1", 0), 2: ("FAIL", "o2", 2)}
    total = media_rollup(verdicts).first()
    assert (total.qa_status, total.featured_approved, total.fallbacks) == ("FAIL", True, 1)
    bins = [0] * 768
    bins[3], bins[256 + 9], bins[512 + 9] = 90, 6, 4
    frame = histogram_percentile(spark.createDataFrame([(bins,)], "h array<bigint>"), "h", 0.95, "p")
    assert frame.first().p == 9.0


def test_json_runs_and_reports(spark, tmp_path):
    for name, text in (("a", '{"products":[{"legacy_id":"1","sku":"x"}]}'), ("b", '[{"legacy_id":"2","sku":"y"}]')):
        (tmp_path / f"{name}.json").write_text(text)
        got = reading.read_products_json(spark, f"{tmp_path}/{name}.json", "legacy_id string, sku string").collect()
        assert [r.legacy_id for r in got] == ["1" if name == "a" else "2"]
    rows = spark.createDataFrame([(1, ["p", "q"], None), (2, [], "z")], "id int, flags array<string>, note string")
    writing.write_report_csv(rows, [("note", "note", ""), ("flags", "flags", ""), ("id", "id", ""), ("absent", "absent", "?")], f"{tmp_path}/report")
    back = spark.read.option("header", True).csv(f"{tmp_path}/report").orderBy("id").collect()
    assert [(r.flags, r.id, r.absent) for r in back] == [("p | q", "1", "?"), (None, "2", "?")]
    for stamp in ("20240101", "20240105"):
        writing.write_run(rows.withColumn("image_status", F.lit("READY")), f"{tmp_path}/runs", stamp)
    newest = reading.latest_run(spark.read.option("basePath", f"{tmp_path}/runs").parquet(f"{tmp_path}/runs"))
    assert newest.count() == 2 and reading.checked_manifest(newest).count() == 2
    with pytest.raises(Exception, match="only a plan"):
        reading.checked_manifest(newest.withColumn("image_status", F.lit("NOT_FETCHED"))).collect()
    writing.write_json(spark.sql("select cast(1.50 as decimal(8,4)) d"), f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").first().d == "1.5"


def test_prepared_products(spark):
    rows = spark.createDataFrame(
        [("1", "9", "S", " انگشتر ", "Rings", "", "desc", "10", "5,000,000", 2, 0, 3, 2, "PASS", []), ("2", "9", "S", "t", "watch", "", "", "", "", 0, 0, 0, 0, None, ["old"])],
        "legacy_id string, code string, sku string, title string, category string, short_description string, description string, weight_text string, legacy_price_text string, images int, missing_images int, readable_views int, qualifying_views int, qa_status string, review_reasons array<string>")
    done = {r.legacy_id: r for r in Q.prepare(rows, qa_run=True).collect()}
    assert done["1"].import_action == "CREATE_DRAFT" and done["1"].price.final_price == 5_900_000 and done["1"].short_description == "desc"
    assert done["2"].import_action == "SKIP_INVALID_REVIEW" and done["2"].review_reasons[0] == "old" and "no safe final price" in done["2"].review_reasons
    assert Q.prepare(rows, qa_run=False).filter("legacy_id = '1'").first().import_action == "BLOCKED_IMAGE_QA_REQUIRED"
    skipped = Q.skipped_rows(spark.createDataFrame([("3", "c", "s", "u", "DUPLICATE_LEGACY_ID", "")], "legacy_id string, code string, sku string, url string, reason string, detail string"))
    report = Q.report_rows(Q.prepare(rows, qa_run=True), skipped)
    assert report.count() == 3 and Q.report_summary(report).first().needing_review == 2
    meta = Q.metadata(Q.prepare(rows, qa_run=True), "shop").filter("legacy_id = '1'").first().meta
    assert meta["manual_price_toman"] == "5900000" and meta["silver_weight_grams"] == "10"


def test_import_file_reader(spark, tmp_path):
    from shelfwise import constants as K

    header = "﻿" + ",".join(K.IMPORT_COLUMNS) + ",extra"
    (tmp_path / "p.csv").write_text(header + "\n" + ",".join(["SKU-RNG-U-1001"] + ["x"] * 13) + ",e\n", encoding="utf-8")
    got = reading.read_import_csv(spark, f"{tmp_path}/p.csv").first()
    assert (got.row_number, got.sku) == (2, "SKU-RNG-U-1001") and "extra" not in got.asDict()
    (tmp_path / "q.csv").write_text("sku\nx\n")
    with pytest.raises(ValueError, match="title_fa"):
        reading.read_import_csv(spark, f"{tmp_path}/q.csv")


def test_published_products_keep_only_wanted_keys(spark):
    rows = spark.createDataFrame([("1", "publish", {"a": "1", "b": "2", "c": ""}), ("x", "publish", {}), ("0", "publish", {}), ("2", "draft", {})], "id string, status string, meta map<string,string>")
    assert [(r.id, r.meta) for r in reading.published_products(rows, ("a", "c")).collect()] == [(1, {"a": "1"})]


def test_stamps(spark):
    from shelfwise.functions import text as T

    moment = F.lit("2024-06-01 00:00:00.000001").cast("timestamp")
    got = spark.range(1).select(T.tehran_stamp(moment).alias("a"), T.tehran_stamp(moment, True).alias("b"), T.utc_iso(moment).alias("c")).first()
    assert (got.a, got.b, got.c) == ("20240601T033000+0330", "20240601T033000000001+0330", "2024-06-01T00:00:00.000001+00:00")


def test_greedy_chain_and_null_ids(spark):
    rows = [(n, f"a{(n + 1) // 2}", f"b{n // 2}") for n in range(60)]  # each row shares a key with the next one
    frame = spark.createDataFrame(rows, "n bigint, a string, b string")
    assert sorted(r.n for r in D.greedy_accept(frame, "n", ["a", "b"]).collect()) == list(range(0, 60, 2))
    nulls = spark.createDataFrame([(n, None, f"c{n}", f"s{n // 2}") for n in range(6)], "n bigint, id bigint, code string, sku string")
    got = {r.n: r.reason for r in D.greedy_claims(nulls, "n", "id", "code", "sku").collect()}
    assert got == {n: None if n % 2 == 0 else "NORMALIZED_SKU_CONFLICT" for n in range(6)}


def test_batch_repeats_come_first_in_import_decisions(spark):
    rows = spark.createDataFrame(
        [(1, "1", "A", "PLAN"), (2, "1", "B", "PLAN"), (3, "2", "b", None), (4, "3", "a", "PLAN"), (5, "9", "Z", "SKIP_INVALID_PRICE"), (6, "9", "z", "PLAN"), (7, "8", "Q", "PLAN"), (8, "7", "S", "PLAN")],
        "row_no bigint, legacy_id string, sku string, action string").withColumn("review_flags", F.array().cast("array<string>"))
    ids = spark.createDataFrame([("8", 80)], "legacy_id string, product_id bigint")
    skus = spark.createDataFrame([("S", 90)], "sku string, product_id bigint")
    got = {r.row_no: (r.decision, r.existing_product) for r in M.import_decisions(rows, ids, skus).collect()}
    assert got == {
        1: ("CREATE_DRAFT", None), 2: ("SKIP_DUPLICATE_BATCH_LEGACY_ID", None), 3: ("CREATE_DRAFT", None), 4: ("SKIP_DUPLICATE_BATCH_SKU", None),
        5: ("SKIP_INVALID_PRICE", None), 6: ("CREATE_DRAFT", None), 7: ("SKIP_EXISTING_LEGACY_ID", 80), 8: ("SKIP_SKU_CONFLICT", 90)}


@pytest.mark.parametrize("change, why", [({"legacy_id": ""}, "STOP_MISSING_IDENTITY"), ({"sku": None}, "STOP_MISSING_IDENTITY"), ({"image_qa_run": False}, "STOP_IMAGE_QA_NOT_RUN"), ({"selected_media": 0}, "STOP_NO_SELECTED_MEDIA"), ({"final_price": None}, "STOP_NO_FINAL_PRICE")])
def test_stop_checks_empty_the_import(spark, change, why):
    schema = "row_no bigint, legacy_id string, sku string, import_action string, image_qa_run boolean, selected_media int, final_price bigint"
    row = {"row_no": 1, "legacy_id": "1", "sku": "A", "import_action": "CREATE_DRAFT", "image_qa_run": True, "selected_media": 2, "final_price": 5}
    none = spark.createDataFrame([], "legacy_id string, sku string, product_id bigint")
    rows = spark.createDataFrame([{**row, **change}, {**row, "row_no": 2, "legacy_id": "2", "sku": "B"}, {**row, "row_no": 3, "import_action": None}], schema)
    kept, blockers = M.stop_all_decisions(rows, none, none)
    assert kept.count() == 0 and [(r.row_no, r.decision) for r in blockers.collect()] == [(1, why)]


def test_hot_attachment_key_is_spread(spark):
    images = spark.createDataFrame([("S", "x.jpg")] * 300, "sku string, image string").repartition(3)
    known = spark.createDataFrame([("S|x.jpg", 5), ("S|x.jpg", 9)], "import_key string, attachment_id bigint")
    got = M.attachment_actions(images, known)
    assert got.count() == 300 and {(r.attachment_id, r.action) for r in got.collect()} == {(5, "REUSE")}


def test_repeated_incoming_keys_give_one_row(spark):
    current = spark.createDataFrame([(1, "old", 0)], "k bigint, v string, at int")
    incoming = spark.createDataFrame([(1, "second", 2), (1, "first", 1), (2, "b", 1), (2, "b", 1), (None, "x", 9)], "k bigint, v string, at int")
    assert sorted(tuple(r) for r in U.upsert(current, incoming, "k", order="at").collect()) == [(1, "second", 2), (2, "b", 1)]
    assert U.upsert(current, incoming, "k").count() == 2


def test_versions_follow_the_log(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert writing.current_version(spark, root) is None
    assert [writing.commit_version(spark.range(n), root) for n in (1, 2)] == [1, 2]
    assert writing.read_current(spark, root).count() == 2 and writing.read_version(spark, root, 1).count() == 1


def test_csv_and_json_keep_every_cell_and_item(spark, tmp_path):
    cells = [(1, 'a "quoted", cell', "two\nlines"), (2, "", 'ends with "')]
    writing.write_report_csv(spark.createDataFrame(cells, "id int, a string, b string"), [(c, c, "") for c in ("id", "a", "b")], f"{tmp_path}/r")
    back = {r.id: (r.a, r.b) for r in reading.read_sheet_csv(spark, f"{tmp_path}/r", multiline=True).collect()}
    assert back == {"1": ('a "quoted", cell', "two\nlines"), "2": (None, 'ends with "')}
    (tmp_path / "p.json").write_text('[{"sku":"y"},{"legacy_id":"2","sku":"z"},{}]')
    assert sorted((r.legacy_id or "", r.sku or "") for r in reading.read_products_json(spark, f"{tmp_path}/p.json", "legacy_id string, sku string").collect()) == [("", ""), ("", "y"), ("2", "z")]
    (tmp_path / "l.json").write_text('{"sku":"y"}\n{"products":[{"sku":"q"},{"sku":"w"}]}\n')
    assert sorted(r.sku for r in reading.read_products_json(spark, f"{tmp_path}/l.json", "legacy_id string, sku string", lines=True).collect()) == ["q", "w", "y"]
    for name in "ab":
        (tmp_path / f"in{name}.csv").write_text("n," + ",".join(__import__("shelfwise").constants.IMPORT_COLUMNS) + "\n5" + ",x" * 14 + "\n")
    with pytest.raises(ValueError, match="row number"):
        reading.read_import_csv(spark, f"{tmp_path}/in*.csv")
    assert {r.row_number for r in reading.read_import_csv(spark, f"{tmp_path}/in*.csv", row_no="n").collect()} == {5}


def test_rescan_loses_and_repeats_no_alert(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, status string").schema
    source, outbox = f"{tmp_path}/in", f"{tmp_path}/out"
    facts = spark.createDataFrame([(i, "10", "IRT", "", "x", [("n", 2)], 1) for i in range(1, 6)], "id bigint, total string, currency string, shipping_city string, billing_city string, first_items array<struct<name:string,quantity:int>>, item_count bigint")

    def arrive(ids, progress):
        spark.createDataFrame([(i, "processing") for i in ids], schema).write.mode("append").parquet(source)
        SO.start_alerts(SO.order_stream(spark, source, schema, "*.parquet"), outbox, f"{tmp_path}/{progress}", enrich=lambda batch: batch.join(facts, "id")).awaitTermination()
        return sorted(r.id for r in SO.read_outbox(spark, outbox).collect())

    assert arrive([1, 2], "p1") == [1, 2]
    assert arrive([2, 3], "p1") == [1, 2, 3]
    assert arrive([4], "p2") == [1, 2, 3, 4]  # a fresh checkpoint reads everything again
    assert "شهر: x" in SO.read_outbox(spark, outbox).first().text


def test_weights_are_priced_exactly(spark):
    from shelfwise.functions import pricing as R

    rows = spark.createDataFrame([("2.00001", 650_000), ("2.00004", 85_000), ("999999999", 85_000), ("99999999999999999999", 1)], "w string, rate bigint").withColumn("w", F.col("w").cast("decimal(38,10)"))
    got = rows.select(
        R.sheet_price(F.lit("none"), F.lit(1).cast("bigint"), F.col("w"))["final_price"].alias("sheet"),
        R.mode_price(F.lit("calc-weight-stone"), F.col("w"), F.lit(100_000).cast("bigint"), F.lit(None).cast("bigint"), F.col("rate")).alias("stone"),
    ).collect()
    assert got[0].sheet == 1_350_000 and got[1].stone == 270_003
    assert got[2].stone == 999_999_999 * 85_000 + 100_000 and got[3].stone is None
