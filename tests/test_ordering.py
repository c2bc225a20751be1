"""The rescan on tables of its own."""

import datetime as dt

from shelfwise.queries import ordering, pricing


def test_rescan_looks_items_up_once_for_all_batches(spark, tmp_path, monkeypatch):
    day = dt.datetime(2024, 1, 1)

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    write("orders", [(i, i % 3, "FOP"[i % 3], i + 0.5, day, "1") for i in range(1, 30)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    write("customer", [(i, i, "BUILDING") for i in range(3)], "c_custkey long, c_nationkey long, c_mktsegment string")
    write("nation", [(i, f"N{i}") for i in range(3)], "n_nationkey long, n_name string")
    write("part", [(i, f"part {i}") for i in range(4)], "p_partkey long, p_name string")
    write("lineitem", [(o, o % 4, 1, n, 2.0) for o in range(1, 20) for n in range(1, 6)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double")
    calls, whole = [], ordering._with_items
    monkeypatch.setattr(ordering, "_with_items", lambda *a: calls.append(1) or whole(*a))
    got = sorted(map(tuple, ordering.stream_rescan(spark, str(tmp_path)).collect()))
    want = sorted((r.id, r.text, 1) for r in ordering.order_alert_text(spark, str(tmp_path)).collect())
    assert got == want and len(got) == sum("FOP"[i % 3] in "FO" for i in range(1, 30)) and len(calls) == 2  # the second is the batch query's


def test_histogram_is_filled_from_its_counts(spark, tmp_path):
    words = ["", "a", "zz" * 200, "b" * 255, "é", "ab"]
    texts = [(1, "one two three four"), (2, ""), (3, None), (4, " ".join(words)), (5, "c" * 300), (6, " ".join("x" * n for n in range(100)))]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = pricing.histogram_p95(spark, str(tmp_path))

    def slow(text):
        sizes = sorted(min(len(w), 255) for w in text.split(" "))
        return float(next(s for i, s in enumerate(sizes, 1) if s != (sizes[i : i + 1] or [None])[0] and i >= len(sizes) * 0.95))

    assert {r.doc_id: r.p95 for r in found.collect()} == {i: slow(t) for i, t in texts if t is not None}
    assert "try_element_at" not in found._jdf.queryExecution().optimizedPlan().toString()  # a walk over the counts for each of 768 bins
