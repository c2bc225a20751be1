"""Greedy claims by component against the sequential walk; a stream that fails between two batches."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shelfwise.operators import dedup as D
from shelfwise.streaming import orders as SO


def walked(rows):
    claimed, out = set(), []
    for n, *keys in sorted(rows):
        own = {(i, k) for i, k in enumerate(keys) if k is not None}
        if not claimed & own:
            claimed |= own
            out.append(n)
    return out


@pytest.mark.parametrize("walk_rows", [D.WALK_ROWS, 40, 6])
def test_claims_equal_the_walk_at_every_component_size(spark, walk_rows):
    rng = random.Random(walk_rows)
    rows = [(n, rng.choice([None, *range(120)]), rng.choice([None, *(f"b{x}" for x in range(120))]), f"c{rng.randrange(400)}") for n in range(400)]
    rows += [(1000 + n, 1000 + (n + 1) // 2, f"d{n // 2}", None) for n in range(30)]  # a chain
    frame = spark.createDataFrame(rows, "n long, a long, b string, c string").repartition(3)
    got = sorted(r.n for r in D.greedy_accept(frame, "n", ["a", "b", "c"], hot_rows=20, walk_rows=walk_rows).collect())
    assert got == walked(rows)


def test_a_long_chain_takes_a_bounded_number_of_steps(spark, monkeypatch):
    n = 100_000
    frame = spark.range(n).select(F.col("id").alias("n"), F.floor((F.col("id") + 1) / 2).alias("a"), F.floor(F.col("id") / 2).alias("b"))
    writes = []
    monkeypatch.setattr(D, "cut_lineage", lambda df, cut=D.cut_lineage: (writes.append(1), cut(df))[1])
    got = D.greedy_accept(frame, "n", ["a", "b"])
    assert got.count() == n // 2 and got.filter("n % 2 = 1").count() == 0 and len(writes) <= 6


def test_components_of_a_chain_take_few_rounds(spark, monkeypatch):
    rows = [(n, (n + 1) // 2, n // 2) for n in range(2000)] + [(5000 + n, 9000 + n, None) for n in range(3)]
    frame = spark.createDataFrame(rows, "n long, a long, b long").repartition(4)
    writes = []
    monkeypatch.setattr(D, "cut_lineage", lambda df, cut=D.cut_lineage: (writes.append(1), cut(df))[1])
    got = {r.n: r.component for r in D.components(frame, "n", ["a", "b"]).collect()}
    assert got == {n: 0 if n < 5000 else n for n, *_ in rows} and len(writes) <= 30


def test_a_backlog_in_steps_survives_a_crash(spark, tmp_path):
    """Files are read two at a time; the second step fails once, and the next run goes on from the stored offset."""
    schema = spark.createDataFrame([], "id bigint, status string").schema
    source, outbox, steps = f"{tmp_path}/in", f"{tmp_path}/out", []
    for start in range(0, 60, 10):
        spark.createDataFrame([(i, "processing") for i in range(start, start + 10)], schema).coalesce(1).write.mode("append").parquet(source)
    facts = spark.createDataFrame(
        [(i, "10", "IRT", "", "x", [("n", 2)], 1) for i in range(60)],
        "id bigint, total string, currency string, shipping_city string, billing_city string, first_items array<struct<name:string,quantity:int>>, item_count bigint",
    )

    def run(fails):
        def enrich(batch):
            steps.append(batch.count())
            if fails and len(steps) == 2:
                raise RuntimeError("lost")
            return batch.join(facts, "id")

        SO.start_alerts(SO.order_stream(spark, source, schema, "*.parquet", 2), outbox, f"{tmp_path}/progress", enrich=enrich).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(True)
    assert sorted(r.id for r in SO.read_outbox(spark, outbox).collect()) == sorted(r.id for r in SO.read_outbox(spark, outbox).select("id").distinct().collect())
    assert SO.read_outbox(spark, outbox).count() == 20 == steps[0]
    run(False)
    assert sorted(r.id for r in SO.read_outbox(spark, outbox).collect()) == list(range(60))
    assert [s for s in steps if s] == [20, 20, 20, 20]  # none of the first step's files is read again
