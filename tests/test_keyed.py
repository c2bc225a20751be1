"""Keyed tables: touched buckets only, lost races, compaction, idempotent re-runs; the outbox index."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import upsert as U
from shelfwise.sources import keyed as K, writing
from shelfwise.streaming import orders as SO


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("m"))
    return K.KeyedTable.create(rows, f"{tmp_path}/t", "k", buckets=16)


def incoming(spark, *rows):
    return spark.createDataFrame([(k, v, {"a": str(k)}) for k, v in rows], "k long, v string, m map<string,string>")


def replace(held, new):
    return U.upsert(held, new, "k")


def test_a_change_touches_its_own_buckets(spark, table):
    before = table.state()
    new = incoming(spark, (3, "new"), (500, "added"), (4, "v4"))
    changed, touched = table.merge(new, replace)
    assert sorted(r.k for r in changed.collect()) == [3, 500]
    state = table.state()
    assert set(touched) == set(table.buckets_of(incoming(spark, (3, ""), (500, "")), state)) and len(touched) <= 2
    assert K.folders_by_version(state)[2] == touched and all(state.folders[b] == before.folders[b] for b in before.folders if b not in touched)
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 201 and got[3] == "new" and got[500] == "added" and got[7] == "v7"
    assert {r.k: r.v for r in table.read(before).collect()}[3] == "v3"  # older versions stay readable


def test_a_lookup_opens_no_other_bucket(spark, table):
    state = table.state()
    one = table.buckets_of(incoming(spark, (3, "")), state)
    files = table.lookup(incoming(spark, (3, "x"))).inputFiles()
    assert [r.k for r in table.lookup(incoming(spark, (3, "x"))).collect()] == [3]
    assert all(f"/{K.BUCKET}={one[0]}/" in f for f in files if "/data/" in f) and sum("/data/" in f for f in files) == 1


def test_the_same_changes_again_write_nothing(spark, table):
    new = incoming(spark, (3, "new"), (500, "added"))
    table.merge(new, replace)
    version = table.state().version
    changed, touched = table.merge(new, replace)
    assert changed.count() == 0 and touched == [] and table.state().version == version


def test_of_two_writers_one_fails(spark, table):
    base = table.state()
    table.commit(incoming(spark, (1, "first")), base)
    with pytest.raises(K.LostRace):
        table.commit(incoming(spark, (1, "second")), base)
    assert {r.k: r.v for r in table.read().collect()}[1] == "first" and table.state().version == base.version + 1


def test_deletes_and_compaction(spark, table):
    for n in range(3):
        table.merge(incoming(spark, (5, f"x{n}"), (6, f"y{n}")), replace)
    table.commit(incoming(spark, (6, "")).withColumn(K.GONE, F.lit(True)), table.state())
    rows = sorted((r.k, r.v) for r in table.read().collect())
    assert len(rows) == 199 and (5, "x2") in rows
    worn = [b for b, n in table.layout().items() if n > 1]
    assert sorted(table.compact()) == sorted(worn) and set(table.layout().values()) == {1}
    assert sorted((r.k, r.v) for r in table.read().collect()) == rows and table.compact() == []


def test_prices_are_changed_in_place(spark, tmp_path):
    store = spark.createDataFrame([(i, str(100 * i), "5") for i in range(40)], "id long, regular_price string, sale_price string")
    table = K.KeyedTable.create(store, f"{tmp_path}/s", "id", buckets=8)
    audit = spark.createDataFrame([(3, 999), (4, 400), (77, 1)], "id long, new_regular_price long")
    gone, touched = U.apply_prices_to(table, audit)
    assert [r.id for r in gone.collect()] == [77] and 0 < len(touched) <= 2
    got = {r.id: (r.regular_price, r.sale_price) for r in table.read().collect()}
    assert got[3] == ("999", None) and got[4] == ("400", None) and got[5] == ("500", "5") and len(got) == 40
    assert U.apply_prices_to(table, audit)[1] == []


def test_two_versions_never_share_a_number(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/v"
    assert writing.commit_version(spark.range(1), root) == 1
    monkeypatch.setattr(writing, "current_version", lambda *_: None)  # a writer that has not seen version 1
    with pytest.raises(K.LostRace):
        writing.commit_version(spark.range(5), root)
    monkeypatch.undo()
    assert writing.read_current(spark, root).count() == 1


def test_a_batch_reads_its_own_outbox_buckets(spark, tmp_path):
    outbox = f"{tmp_path}/out"
    rows = spark.range(300).select("id", F.lit("t").alias("text"), SO.outbox_bucket(F.col("id")).alias("bucket"), F.lit("r").alias("run"), F.lit(0).alias("batch"))
    rows.write.partitionBy("bucket", "run", "batch").parquet(outbox)
    own = [r[0] for r in rows.filter("id < 3").select("bucket").distinct().collect()]
    found = SO.sent_ids(spark, outbox, own)
    assert {0, 1, 2} <= {r.id for r in found.collect()}
    assert {f.split("/bucket=")[1].split("/")[0] for f in found.inputFiles()} == {str(b) for b in own}
    assert SO.sent_ids(spark, f"{tmp_path}/none", own) is None
