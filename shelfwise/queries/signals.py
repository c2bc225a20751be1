"""Order signals and follow-up messages over the event and order tables, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import followups as U, signals as S
from shelfwise.operators.prefix import counts_in_range
from shelfwise.queries import views as V
from shelfwise.queries.ordering import _run_folder
from shelfwise.registry import query, table
from shelfwise.streaming import followups as SU, signals as SS

# An account is shared by ten users, as a phone or an address may be: one user's events are hours apart in these tables, so
# spans are hours where a shop has minutes.
EVENTS = """
SELECT event_id, user_id AS customer, CAST(floor(user_id / 10) AS BIGINT) AS account, CAST(ts AS TIMESTAMP) AS moment, event_type AS kind,
  CAST(round(value * 100) AS BIGINT) AS amount, CAST(CAST(floor(value) AS BIGINT) % 7 AS STRING) AS basket
FROM {events}
"""
# Baskets of coarse lines, so that equal ones occur; orders of a hundred customers count as those of one account.
ORDERS = "SELECT o_orderkey AS order_id, o_custkey % 100 AS account, CAST(o_orderdate AS TIMESTAMP) AS moment, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM {orders}"
LINES = "SELECT l_orderkey AS order_id, l_partkey % 3 AS item, CAST(l_quantity AS BIGINT) % 2 AS quantity FROM {lineitem}"
_E = f"e AS ({V.as_sql(EVENTS)})"
_P = f"{_E}, p AS (SELECT event_id, account, moment, amount, basket FROM e WHERE kind = 'purchase')"
_O = f"o AS ({V.as_sql(ORDERS)}), l AS ({V.as_sql(LINES)})"

LIMITS = {"failures": S.FAILURES, "burst": S.BURST, "unusual": 2}
SPANS = {"failures": "12 hours", "repeat": "12 hours", "burst": "24 hours"}
LATE = "2 hours"

RULES = (
    U.FollowUp("cart", ("click",), ("click", "purchase"), 2),
    U.FollowUp("review", ("purchase",), (), 3 * 24, promotional=False),
    U.FollowUp("second", ("purchase",), ("purchase",), 14 * 24),
    U.FollowUp("inactive", ("view", "click", "purchase"), ("view", "click", "purchase"), 30 * 24),
)


def _events(spark, folder) -> DataFrame:
    return V.view(spark, folder, EVENTS)


def _purchases(spark, folder) -> DataFrame:
    return _events(spark, folder).filter("kind = 'purchase'").select("event_id", "account", "moment", "amount", "basket")


def _failures(spark, folder) -> DataFrame:
    return _events(spark, folder).filter("kind = 'error'").select("event_id", "account", "moment")


def _event_stream(spark, folder) -> DataFrame:
    stream = spark.readStream.schema(table(spark, folder, "events").schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    stream.createOrReplaceTempView("shelfwise_event_stream")
    return spark.sql(EVENTS.format(events="shelfwise_event_stream"))


_WINDOWS = f"""
WITH {_E}, m AS (
  SELECT account, epoch_us(moment) // 3600000000 AS hour, count(*) AS c FROM e WHERE kind = 'error' GROUP BY ALL
), s AS (
  SELECT account, hour - j AS hour, max(CASE WHEN j = 0 THEN c ELSE 0 END) AS c FROM m, range(12) AS steps(j) GROUP BY ALL
), w AS (
  SELECT account, hour, sum(c) OVER (PARTITION BY account ORDER BY hour RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING) AS n FROM s
)
SELECT account, make_timestamp(hour * 3600000000) AS start, make_timestamp((hour + 12) * 3600000000) AS "end", CAST(n AS BIGINT) AS n FROM w WHERE n > 3
"""


@query("failure_windows", _WINDOWS)
def failure_windows(spark, folder):
    """Sliding windows with too many failed payments."""
    return S.failure_windows(_failures(spark, folder), "account", "moment", S.FAILURES, "12 hours", "1 hour")


@query("stream_failure_windows", _WINDOWS + " AND (hour + 12) * 3600000000 <= (SELECT epoch_us(max(moment)) - 7200000000 FROM e WHERE kind = 'error')")
def stream_failure_windows(spark, folder):
    """The windows of ``failure_windows`` that the watermark has passed, from a stream."""
    work = _run_folder(spark, "failures")
    failures = _event_stream(spark, folder).filter("kind = 'error'")
    SS.start_failure_windows(failures, f"{work}/out", f"{work}/progress", "account", "moment", LATE, S.FAILURES, "12 hours", "1 hour").awaitTermination()
    return spark.read.schema("account bigint, start timestamp, end timestamp, n bigint").parquet(f"{work}/out")


@query("order_range_counts", f"""WITH {_P}
SELECT event_id, account, count(*) OVER (PARTITION BY account ORDER BY moment RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS n FROM p""")
def order_range_counts(spark, folder):
    """Orders of an account in the day up to each order, without a window over an account."""
    return counts_in_range(_purchases(spark, folder), "account", "moment", "event_id", SPANS["burst"])


@query("order_bursts", f"""WITH {_P}, c AS (
SELECT event_id, account, count(*) OVER (PARTITION BY account ORDER BY moment RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS n FROM p)
SELECT * FROM c WHERE n >= 5""")
def order_bursts(spark, folder):
    return S.bursts(_purchases(spark, folder), "account", "moment", "event_id", S.BURST, SPANS["burst"])


@query("repeated_baskets", f"""WITH {_O}, b AS (
SELECT order_id, string_agg(CAST(item AS VARCHAR) || 'x' || CAST(quantity AS VARCHAR), ',' ORDER BY item, quantity) AS basket FROM l GROUP BY order_id
), d AS (SELECT o.order_id, account, moment, basket FROM o JOIN b ON o.order_id = b.order_id),
w AS (SELECT *, lag(moment) OVER (PARTITION BY account, basket ORDER BY moment, order_id) AS before FROM d)
SELECT account, order_id FROM w WHERE before >= moment - INTERVAL 30 DAYS""")
def repeated_baskets(spark, folder):
    """Orders whose account ordered the same multiset of lines in the thirty days before."""
    digests = S.basket_digests(V.view(spark, folder, LINES), "order_id", ["item", "quantity"])
    orders = V.view(spark, folder, ORDERS).join(digests, "order_id")
    return S.repeated_baskets(orders, "account", "moment", "order_id", "digest", "30 days")


@query("order_history", f"""WITH {_O} SELECT order_id, account, count(*) OVER w AS earlier, CAST(coalesce(sum(cents) OVER w, 0) AS BIGINT) AS spent
FROM o WINDOW w AS (PARTITION BY account ORDER BY moment, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def order_history(spark, folder):
    """Number and exact total of an account's orders before each order."""
    return S.own_history(V.view(spark, folder, ORDERS), "account", "moment", "order_id", "cents").select("order_id", "account", "earlier", "spent")


@query("unusual_amounts", f"""WITH {_O}, h AS (SELECT *, count(*) OVER w AS earlier, coalesce(sum(cents) OVER w, 0) AS spent
FROM o WINDOW w AS (PARTITION BY account ORDER BY moment, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT order_id, account, cents, earlier, CAST(spent AS BIGINT) AS spent FROM h WHERE earlier > 0 AND cents * earlier > spent * 2""")
def unusual_amounts(spark, folder):
    found = S.unusual_amounts(V.view(spark, folder, ORDERS), "account", "moment", "order_id", "cents", 2)
    return found.select("order_id", "account", "cents", "earlier", "spent")


_BITS = f"""
WITH {_P}, f AS (SELECT account, moment FROM e WHERE kind = 'error'),
half AS (SELECT make_timestamp(CAST(floor((epoch_us(min(moment)) + epoch_us(max(moment))) / 2) AS BIGINT)) AS t FROM p),
h AS (SELECT account, count(*) AS earlier, sum(amount) AS spent FROM p, half WHERE moment <= t GROUP BY account),
s AS (
  SELECT p.event_id, 1 AS bit FROM p JOIN f ON f.account = p.account AND f.moment BETWEEN p.moment - INTERVAL 12 HOURS AND p.moment GROUP BY p.event_id HAVING count(*) > 3
  UNION ALL
  SELECT DISTINCT p.event_id, 2 FROM p JOIN p AS q ON q.account = p.account AND q.basket = p.basket AND q.moment BETWEEN p.moment - INTERVAL 12 HOURS AND p.moment
    AND (q.moment < p.moment OR q.event_id < p.event_id)
  UNION ALL
  SELECT event_id, 4 FROM (SELECT event_id, count(*) OVER (PARTITION BY account ORDER BY moment RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS n FROM p) WHERE n >= 5
  UNION ALL
  SELECT event_id, 8 FROM p JOIN h ON h.account = p.account WHERE amount * earlier > spent * 2
),
b AS (SELECT p.event_id, CAST(coalesce(sum(bit), 0) AS INTEGER) AS bits, p.moment FROM p LEFT JOIN s ON s.event_id = p.event_id GROUP BY p.event_id, p.moment)
SELECT event_id, bits, CASE WHEN bit_count(bits) >= 2 OR bits & 4 <> 0 THEN 3 WHEN bits <> 0 THEN 2 ELSE 1 END AS tier FROM b
"""


def _history(purchases: DataFrame) -> DataFrame:
    """Totals of each account in the first half of the time the table covers."""
    half = purchases.agg(F.timestamp_micros(F.floor((F.unix_micros(F.min("moment")) + F.unix_micros(F.max("moment"))) / 2))).scalar()
    return purchases.filter(F.col("moment") <= half).groupBy("account").agg(F.count(F.lit(1)).alias("earlier"), F.sum("amount").alias("spent"))


@query("order_tiers", _BITS)
def order_tiers(spark, folder):
    """Tier of every order by its signals."""
    orders, failures = _purchases(spark, folder), _failures(spark, folder)
    signals = {
        "failures": S.after_failures(orders, failures, "account", "moment", "event_id", LIMITS["failures"], SPANS["failures"]),
        "repeat": S.repeated_baskets(orders, "account", "moment", "event_id", "basket", SPANS["repeat"]),
        "burst": S.bursts(orders, "account", "moment", "event_id", LIMITS["burst"], SPANS["burst"]),
        "unusual": S.above_history(orders, _history(orders), "account", "amount", LIMITS["unusual"]),
    }
    return S.tiers(orders, "event_id", signals, severe=["burst"])


@query("stream_order_tiers", _BITS + " WHERE moment <= (SELECT max(moment) FROM p) - INTERVAL 26 HOURS")
def stream_order_tiers(spark, folder):
    """The tiers of ``order_tiers`` for the orders the watermark has passed by the longest span, from an outer join of streams."""
    work = _run_folder(spark, "tiers")
    known = _event_stream(spark, folder).withColumn("customer", F.col("account"))
    orders = known.filter("kind = 'purchase'").select(F.col("event_id").alias("order_id"), "customer", "moment", "basket", "amount")
    evidence = known.filter("kind in ('purchase', 'error')").select("customer", "moment", "event_id", (F.col("kind") == "error").alias("failed"), "basket")
    history = _history(_purchases(spark, folder)).withColumnRenamed("account", "customer")
    SS.appended(SS.order_bits(orders, evidence, history, LATE, LIMITS, SPANS), f"{work}/out", f"{work}/progress").awaitTermination()
    found = spark.read.schema("order_id bigint, customer bigint, moment timestamp, bits int, tier int").parquet(f"{work}/out")
    return found.select(F.col("order_id").alias("event_id"), "bits", "tier")


def _due_sql(until: str) -> str:
    parts = []
    for rule in RULES:
        on, off = (", ".join(f"'{k}'" for k in kinds) for kinds in (rule.on, rule.off))
        off_too = f" AND NOT EXISTS (SELECT 1 FROM e AS x WHERE x.customer = e.customer AND x.kind IN ({off}) AND x.moment > e.moment AND x.moment <= e.moment + INTERVAL {rule.hours} HOURS)" if off else ""
        parts.append(
            f"SELECT customer, '{rule.name}' AS rule, event_id, moment, moment + INTERVAL {rule.hours} HOURS AS due FROM e WHERE kind IN ({on}) AND moment + INTERVAL {rule.hours} HOURS <= {until}{off_too}"
        )
    return " UNION ALL ".join(parts)


@query("follow_ups", f"WITH {_E} " + _due_sql("(SELECT max(moment) FROM e)"))
def follow_ups(spark, folder):
    """Cart, review, second-purchase and inactivity messages due by the last event."""
    return U.due_messages(_events(spark, folder), RULES)


@query("stream_follow_ups", f"WITH {_E} " + _due_sql("(SELECT max(moment) FROM e) - INTERVAL 2 HOURS"))
def stream_follow_ups(spark, folder):
    """The messages of ``follow_ups`` due by the watermark, from a stream with timers."""
    work = _run_folder(spark, "messages")
    SU.start_follow_ups(_event_stream(spark, folder), RULES, f"{work}/out", f"{work}/progress", LATE).awaitTermination()
    return spark.read.schema("customer bigint, rule string, event_id bigint, moment timestamp, due timestamp").parquet(f"{work}/out")


@query("weekly_messages", f"""WITH RECURSIVE {_E}, due AS ({_due_sql('(SELECT max(moment) FROM e)')}),
m AS (SELECT customer, event_id * 10 + CASE rule WHEN 'cart' THEN 0 WHEN 'second' THEN 1 ELSE 2 END AS message_id, due, due + INTERVAL 210 MINUTES AS local FROM due WHERE rule <> 'review'),
t AS (SELECT customer, message_id, CASE WHEN hour(local) < 9 THEN date_trunc('day', local) + INTERVAL 330 MINUTES
  WHEN hour(local) >= 21 THEN date_trunc('day', local) + INTERVAL 1770 MINUTES ELSE due END AS send_at FROM m),
walk AS (
  SELECT customer, message_id, send_at FROM (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY send_at, message_id) AS k FROM t) WHERE k = 1
  UNION ALL
  SELECT customer, message_id, send_at FROM (
    SELECT t.*, row_number() OVER (PARTITION BY t.customer ORDER BY t.send_at, t.message_id) AS k FROM walk JOIN t ON t.customer = walk.customer AND t.send_at >= walk.send_at + INTERVAL 7 DAYS
  ) WHERE k = 1
)
SELECT customer, message_id, send_at FROM walk""")
def weekly_messages(spark, folder):
    """Promotional messages, moved into sending hours and at most one a week for each customer."""
    due = U.due_messages(_events(spark, folder), [r for r in RULES if r.promotional])
    number = F.when(F.col("rule") == "cart", 0).when(F.col("rule") == "second", 1).otherwise(2)
    messages = due.select("customer", "due", (F.col("event_id") * 10 + number).alias("message_id"))
    return U.weekly(messages).select("customer", "message_id", "send_at")
