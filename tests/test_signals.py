"""Signals and follow-ups: hot customers, late rows, restarts, null keys and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import followups as U, prefix as P, signals as S
from shelfwise.streaming import followups as SU, signals as SS

START = dt.datetime(2024, 1, 1)
RULES = (U.FollowUp("cart", ("click",), ("click", "purchase"), 2), U.FollowUp("review", ("purchase",), (), 72, False), U.FollowUp("second", ("purchase",), ("purchase",), 336))


def minutes(n):
    return START + dt.timedelta(minutes=n)


def random_events(seed=3, n=600):
    """A third of all rows belong to one customer; equal times and null customers occur."""
    rng = random.Random(seed)
    return [
        (rng.choice([None, 7, 7, *range(1, 5)]), i, minutes(rng.randrange(0, 9000, 5)), rng.choice(["click", "purchase", "view", "error"]))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(random_events(), "customer long, event_id long, moment timestamp, kind string").repartition(3)


def test_counts_in_range_equal_the_frame(spark, events):
    got = {r.event_id: r.n for r in P.counts_in_range(events, "customer", "moment", "event_id", "10 hours").collect()}
    rows = [r for r in random_events() if r[0] is not None]
    assert got == {i: sum(c == d and at - dt.timedelta(hours=10) <= t <= at for d, _, t, _ in rows) for c, i, at, _ in rows}


def test_a_hot_customer_fills_several_tasks(spark):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("k"), F.col("id"), F.timestamp_seconds(F.col("id")).alias("t"))
    found = P.running_totals(rows, "k", ["t", "id"], {"n": F.lit(1).cast("long")})
    assert found.filter("n <> id + 1").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "__range" in plan and "BroadcastHashJoin" in plan


def test_messages_keep_their_distance(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), i, minutes(rng.randrange(0, 60 * 24 * 90, 60))) for i in range(500)]
    frame = spark.createDataFrame(rows, "customer long, message_id long, t timestamp")
    want = []
    for customer in (1, 2, 3):
        last = None
        for _, i, t in sorted((r for r in rows if r[0] == customer), key=lambda r: (r[2], r[1])):
            if last is None or t >= last + dt.timedelta(days=7):
                want.append(i)
                last = t
    assert sorted(r.message_id for r in P.spaced(frame, "customer", "t", "message_id", "7 days").collect()) == sorted(want)
    assert P.spaced(frame.limit(0), "customer", "t", "message_id", "7 days").count() == 0


def test_sending_hours(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 29),) for h in (2, 5, 12, 17, 18)], "due timestamp")
    got = [r[0] for r in frame.select(U.in_hours(F.col("due"))).collect()]
    assert got == [dt.datetime(2024, 1, 1, 5, 30)] * 2 + [dt.datetime(2024, 1, 1, 12, 29), dt.datetime(2024, 1, 1, 17, 29), dt.datetime(2024, 1, 2, 5, 30)]


def test_baskets_match_in_any_order_and_within_the_span(spark):
    lines = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (2, 6, 2), (2, 5, 1), (3, 5, 1), (3, 6, 2), (3, 6, 2), (4, 5, 2), (4, 6, 1)], "order_id long, item long, quantity long")
    digests = {r.order_id: r.digest for r in S.basket_digests(lines, "order_id", ["item", "quantity"]).collect()}
    assert digests[1] == digests[2] and len(set(digests.values())) == 3
    times = {10: 0, 11: 9, 12: 19, 13: 29.5, 14: 29.5, 15: 100, 16: 110.1, 17: 0, 18: 1}
    rows = [(i, 2 if i == 17 else None if i == 18 else 1, START + dt.timedelta(minutes=t), "d") for i, t in times.items()]
    orders = spark.createDataFrame(rows, "order_id long, who long, t timestamp, digest string")
    assert sorted(r.order_id for r in S.repeated_baskets(orders, "who", "t", "order_id", "digest", "10 minutes", hot_rows=3).collect()) == [11, 12, 14]


def test_unusual_amounts_are_compared_exactly(spark):
    rows = [(i, 1, START + dt.timedelta(days=i), a) for i, a in enumerate([100, 300, 601, 1001, 10**15])] + [(9, None, START, 5)]
    orders = spark.createDataFrame(rows, "order_id long, who long, t timestamp, cents long")
    assert sorted(r.order_id for r in S.unusual_amounts(orders, "who", "t", "order_id", "cents", 3).collect()) == [2, 4]
    got = {r.order_id: (r.earlier, r.spent) for r in S.own_history(orders, "who", "t", "order_id", "cents").collect()}
    assert got == {0: (0, 0), 1: (1, 100), 2: (2, 400), 3: (3, 1001), 4: (4, 2002)}


def test_tiers(spark):
    orders = spark.range(5).select(F.col("id").alias("order_id"))
    some = lambda *ids: spark.createDataFrame([(i,) for i in ids], "order_id long")
    got = {r.order_id: (r.bits, r.tier) for r in S.tiers(orders, "order_id", {"a": some(1, 1, 2), "b": some(2), "c": some(3)}, severe=["c"]).collect()}
    assert got == {0: (0, 1), 1: (1, 2), 2: (3, 3), 3: (4, 3), 4: (0, 1)}


def slow_messages(rows, until):
    out = []
    for rule in RULES:
        for customer, i, at, kind in rows:
            due = at + dt.timedelta(hours=rule.hours)
            if customer is not None and kind in rule.on and due <= until and not any(c == customer and k in rule.off and at < t <= due for c, _, t, k in rows):
                out.append((customer, rule.name, i, at, due))
    return sorted(out)


def test_messages_equal_the_search(spark, events):
    rows = random_events()
    until = max(t for c, _, t, _ in rows if c is not None)
    assert sorted(map(tuple, U.due_messages(events, RULES, hot_rows=20).collect())) == slow_messages(rows, until)


def arrive(spark, source, rows, name):
    frame = spark.createDataFrame(rows, "customer long, event_id long, moment timestamp, kind string")
    frame.coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(frame.schema).parquet(source)


def test_messages_survive_restarts_and_disorder(spark, tmp_path):
    """Three runs on one checkpoint, each with events up to an hour out of order: as the batch over all events."""
    rng = random.Random(4)
    rows = sorted((r for r in random_events(8, 300) if r[0] is not None), key=lambda r: r[2] + dt.timedelta(minutes=rng.randrange(50)))
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    for n, part in enumerate((rows[:90], rows[90:180], rows[180:])):
        stream = arrive(spark, source, part, n)
        SU.start_follow_ups(stream, RULES, target, f"{tmp_path}/progress", "1 hour").awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(target).select("customer", "rule", "event_id", "moment", "due").collect()))
    assert got == slow_messages(rows, max(r[2] for r in rows) - dt.timedelta(hours=1))


def test_late_failures_change_no_closed_window(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    first = [(1, i, minutes(i), "error") for i in range(4)] + [(2, 9, minutes(60), "error")]
    late = [(1, 20, minutes(5), "error"), (3, 21, minutes(1), "error"), (2, 22, minutes(200), "error")]  # before 00:50: dropped
    for part in (first, late):
        stream = arrive(spark, source, part, "f")
        SS.start_failure_windows(stream, target, f"{tmp_path}/progress", "customer", "moment").awaitTermination()
    got = {(r.customer, r.start, r.n) for r in spark.read.parquet(target).collect()}
    assert got == {(1, minutes(-6 + i), 4) for i in range(7)}
    everything = S.failure_windows(spark.read.parquet(source), "customer", "moment")
    assert {r.n for r in everything.collect()} == {4, 5}


class Calls:
    """State, timers and the number of times each was asked for, as the engine hands them to a processor."""

    def __init__(self):
        self.n, self.timers = 0, set()

    def getListState(self, name, schema):  # noqa: N802
        return Held(self, [])

    def getValueState(self, name, schema):  # noqa: N802
        return Held(self, None)

    def getMapState(self, name, keys, values):  # noqa: N802
        return Pairs(self)

    def registerTimer(self, at):  # noqa: N802
        self.n += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.n += 1
        self.timers.discard(at)


class Held:
    def __init__(self, calls, empty):
        self.calls, self.empty, self.value = calls, empty, empty

    def get(self):
        self.calls.n += 1
        return iter(self.value) if isinstance(self.value, list) else self.value

    def put(self, value):
        self.calls.n += 1
        self.value = value

    update = put

    def clear(self):
        self.put(self.empty)


class Pairs:
    def __init__(self, calls):
        self.calls, self.value = calls, {}

    def iterator(self):
        self.calls.n += 1
        return iter([*self.value.items()])

    def updateValue(self, key, value):  # noqa: N802
        self.calls.n += 1
        self.value[key] = value

    def removeKey(self, key):  # noqa: N802
        self.calls.n += 1
        self.value.pop(key, None)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


def test_state_is_asked_a_few_times_a_customer_however_many_events():
    rule = U.FollowUp("review", ("purchase",), (), 1, promotional=False)
    calls, many = Calls(), 400
    waits = SU.Waiting([rule])
    waits.init(calls)
    rows = SU.pd.DataFrame({"at_micros": [i * 60_000_000 for i in range(many)], "event_id": range(many), "kind": ["purchase"] * many})
    list(waits.handleInputRows((1,), iter([rows]), At(0)))
    got, rounds = [], 0
    for mark in (SU.HOUR // 1000 + 6_000_000, 10**9):  # after the hundredth message, after all
        while due := sorted(t for t in calls.timers if t <= mark):
            rounds += 1
            got += [e for part in waits.handleExpiredTimer((1,), At(mark), At(due[0])) for e in part["event_id"]]
            calls.timers.discard(due[0])
    assert sorted(got) == list(range(many)) and rounds == 2 and calls.n < 30
