"""Failed-payment windows and order tiers as streams.

Late rows: a row is used as long as its time is not before the watermark, the latest time seen less ``late``; an older one is
dropped, since its window or its order's join has been closed and written. Results are appended once, when the watermark has
passed them, so replays and restarts on the same checkpoint neither change nor repeat a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators import signals as S

LATE = "10 minutes"
BITS = ("failures", "repeat", "burst", "unusual")


def appended(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def start_failure_windows(
    failures: DataFrame, target: str, checkpoint: str, key: str, at: str, late: str = LATE,
    limit: int = S.FAILURES, span: str = S.FAILURE_SPAN, step: str = S.FAILURE_STEP,
) -> StreamingQuery:
    """Sliding windows with more than ``limit`` failed payments, each written when it can no longer change."""
    return appended(S.failure_windows(failures.withWatermark(at, late), key, at, limit, span, step), target, checkpoint)


def order_bits(orders: DataFrame, evidence: DataFrame, history: DataFrame, late: str, limits: dict[str, int], spans: dict[str, str]) -> DataFrame:
    """order_id, customer, moment, bits and tier of a stream of orders.

    ``orders``: order_id, customer, moment, basket, amount. ``evidence``: customer, moment, event_id, failed (a failed payment, else an
    order), basket. The two streams meet in one outer join on the customer and the longest span before the order, which keeps
    no more state than that span and the lateness; what an order met is then folded into its bits, and written once the watermark
    has passed the order by that span. ``history`` is a table: customer, earlier, spent.
    """
    longest = max(spans.values(), key=_seconds)
    left = orders.withWatermark("moment", late)
    right = evidence.select(F.col("customer").alias("who"), F.col("moment").alias("met_at"), "event_id", "failed", F.col("basket").alias("met_basket")).withWatermark("met_at", late)
    near = (F.col("customer") == F.col("who")) & (F.col("met_at") <= F.col("moment")) & (F.col("met_at") >= F.col("moment") - F.expr(f"interval {longest}"))
    within = lambda name: F.col("met_at") >= F.col("moment") - F.expr(f"interval {spans[name]}")
    earlier = (F.col("met_at") < F.col("moment")) | (F.col("event_id") < F.col("order_id"))
    met = left.join(right, near, "left").groupBy("moment", "order_id", "customer", "amount").agg(
        F.count_if(F.col("failed") & within("failures")).alias("failures"),
        F.count_if(~F.col("failed") & (F.col("basket") == F.col("met_basket")) & earlier & within("repeat")).alias("repeats"),
        F.count_if(~F.col("failed") & within("burst")).alias("burst"),
    )
    known = met.join(history, "customer", "left")
    unusual = F.coalesce((F.col("earlier") > 0) & (F.col("amount") * F.col("earlier") > F.col("spent") * limits["unusual"]), F.lit(False))
    flags = [F.col("failures") > limits["failures"], F.col("repeats") > 0, F.col("burst") >= limits["burst"], unusual]
    bits = sum(F.when(flag, 1 << place).otherwise(0) for place, flag in enumerate(flags))
    return known.select("order_id", "customer", "moment", bits.alias("bits")).withColumn("tier", S.tier(F.col("bits"), 1 << BITS.index("burst")))


def _seconds(span: str) -> float:
    number, unit = span.split()
    return float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
