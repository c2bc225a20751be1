"""Follow-up messages: due a while after an event unless something happened in between, and at most one a week."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.keys import HOT_ROWS, lookup
from shelfwise.operators.prefix import spaced

WEEK = "7 days"
OPENS, CLOSES, ZONE = 9, 21, "Asia/Tehran"


@dataclass(frozen=True)
class FollowUp:
    """A message due ``hours`` after each event in ``on``, unless the customer has an event in ``off`` after it and up to then."""

    name: str
    on: tuple[str, ...]
    off: tuple[str, ...]
    hours: int
    promotional: bool = True


def due_messages(events: DataFrame, rules: Sequence[FollowUp], until: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """customer, rule, event_id, moment and due of every message due by ``until`` (default: the last event's time).

    ``events``: customer, event_id (unique), moment, kind. Time is cut into slots as long as the delay: an event calls a message
    off if it is the last of the trigger's own slot and later than it, or the first of the next slot and not beyond the due
    time. So the cancelling events are two aggregates a slot, and triggers look them up by customer and slot, salted where hot.
    """
    known = events.filter(F.col("customer").isNotNull() & F.col("moment").isNotNull())
    now = known.agg(F.max("moment")).scalar() if until is None else until
    micros = F.unix_micros(F.col("moment").cast("timestamp"))
    out = []
    for rule in rules:
        width = rule.hours * 3_600_000_000
        slot = F.floor(micros / width)
        name = lambda number: F.concat_ws(":", F.col("customer").cast("string"), number.cast("string"))
        due = (F.col("moment") + F.expr(f"interval {rule.hours} hours")).alias("due")
        found = known.filter(F.col("kind").isin(*rule.on) & (F.col("moment") + F.expr(f"interval {rule.hours} hours") <= now))
        found = found.select("customer", F.lit(rule.name).alias("rule"), "event_id", "moment", due, micros.alias("__at"), name(slot).alias("__own"), name(slot + 1).alias("__next"))
        if rule.off:
            edges = known.filter(F.col("kind").isin(*rule.off)).select(name(slot).alias("__own"), micros.alias("__at")).groupBy("__own").agg(F.max("__at").alias("__last"), F.min("__at").alias("__first"))
            counted = found
            found = lookup(found, edges.drop("__first"), "__own", ["event_id"], hot_rows=hot_rows)
            found = lookup(found, edges.select(F.col("__own").alias("__next"), "__first"), "__next", ["event_id"], hot_rows=hot_rows, counted=counted)
            off = (F.col("__last") > F.col("__at")) | (F.col("__first") <= F.col("__at") + width)
            found = found.filter(~F.coalesce(off, F.lit(False)))
        out.append(found.select("customer", "rule", "event_id", "moment", "due"))
    return reduce(DataFrame.unionByName, out)


def in_hours(due: Column, opens: int = OPENS, closes: int = CLOSES, zone: str = ZONE) -> Column:
    """The first moment from ``due`` on at which messages may be sent: from ``opens`` to before ``closes`` o'clock of the zone."""
    local = F.from_utc_timestamp(due, zone)
    day = F.date_trunc("day", local)
    opening = lambda days: F.to_utc_timestamp(day + F.make_dt_interval(F.lit(days), F.lit(opens)), zone)
    return F.when(F.hour(local) < opens, opening(0)).when(F.hour(local) >= closes, opening(1)).otherwise(due)


def weekly(messages: DataFrame, span: str = WEEK) -> DataFrame:
    """Messages with ``send_at``, each at least ``span`` after the one the customer was sent before.

    ``messages``: customer, message_id (unique) and due. Of several at one time the least id is sent.
    """
    timed = messages.withColumn("send_at", in_hours(F.col("due")))
    return spaced(timed, "customer", "send_at", "message_id", span)
