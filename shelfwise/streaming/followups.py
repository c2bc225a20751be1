"""Follow-up messages from a stream: keyed state with one timer for the messages that wait.

A customer's state holds the messages that wait and the events newer than the watermark that call messages off, so events that come out of
order within ``late`` give the same messages as in order. Both are lists that are read and written once for each batch a customer
appears in. One timer, on the earliest due time, wakes the customer; all messages that are due by the watermark are then
written together, once for good (state, timers and output commit together with the checkpoint), and the timer is set to the next one.
A customer's events are handled by one task a batch, which keeps the waiting messages of that customer only.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shelfwise.operators.followups import FollowUp
from shelfwise.streaming.signals import LATE, appended

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MESSAGE = "customer long, rule string, event_id long, at_micros long, due_micros long"
HOUR = 3_600_000_000


class Waiting(StatefulProcessor):
    """Messages of one customer that wait for their time."""

    def __init__(self, rules: Sequence[FollowUp]):
        self.rules = {rule.name: rule for rule in rules}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getListState("messages", "rule string, event_id long, at long")
        self.recent = handle.getListState("recent", "at long, kind string")
        self.timer = handle.getValueState("timer", "moment long")

    @staticmethod
    def wakes(due: int) -> int:
        """Timers count milliseconds."""
        return -(-due // 1000)

    @staticmethod
    def called_off(off: list[int], at: int, length: int) -> bool:
        """Whether one of the sorted times lies after ``at`` and up to ``length`` later."""
        after = bisect_right(off, at)
        return after < len(off) and off[after] <= at + length

    def due(self, rule: str, at: int) -> int:
        return at + self.rules[rule].hours * HOUR

    def keep(self, held: dict[tuple[str, int], int], fired: bool = False) -> None:
        """Write the messages that wait, and one timer on the earliest of them."""
        before = self.timer.get()
        before = None if before is None or before[0] is None else before[0]
        if held:
            self.messages.put([(rule, event_id, at) for (rule, event_id), at in held.items()])
        else:
            self.messages.clear()
        wake = min((self.wakes(self.due(rule, at)) for (rule, _), at in held.items()), default=None)
        if wake == before and not fired:
            return
        if before is not None and not fired:
            self.handle.deleteTimer(before)
        if wake is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(wake)
            self.timer.update((wake,))

    def waiting(self) -> dict[tuple[str, int], int]:
        return {(rule, event_id): at for rule, event_id, at in self.messages.get()}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        events = sorted((int(at), int(event_id), kind) for part in rows for at, event_id, kind in zip(part["at_micros"], part["event_id"], part["kind"], strict=True))
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        recent = set(map(tuple, self.recent.get()))
        new = {(at, kind) for at, _, kind in events}
        held = self.waiting()
        for name, rule in self.rules.items():
            length = rule.hours * HOUR
            off = sorted(at for at, kind in new if kind in rule.off)
            for k in [k for k, at in held.items() if k[0] == name and self.called_off(off, at, length)]:
                del held[k]
            off = sorted(at for at, kind in new | recent if kind in rule.off)
            held.update({(name, event_id): at for at, event_id, kind in events if kind in rule.on and not self.called_off(off, at, length)})
        self.keep(held)
        newer = sorted((k for k in new | recent if k[0] > passed), key=lambda k: (k[0], k[1] or ""))
        if newer:
            self.recent.put(newer)
        elif recent:
            self.recent.clear()
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        moment, held = timerValues.getCurrentWatermarkInMs(), self.waiting()
        due = {k: self.due(k[0], at) for k, at in held.items()}
        ready = sorted(k for k in held if self.wakes(due[k]) <= moment)
        self.keep({k: at for k, at in held.items() if self.wakes(due[k]) > moment}, fired=True)
        yield pd.DataFrame(
            {"customer": [key[0]] * len(ready), "rule": [k[0] for k in ready], "event_id": [k[1] for k in ready], "at_micros": [held[k] for k in ready], "due_micros": [due[k] for k in ready]}
        )

    def close(self) -> None:
        pass


def start_follow_ups(events: DataFrame, rules: Sequence[FollowUp], target: str, checkpoint: str, late: str = LATE) -> StreamingQuery:
    """Messages of ``rules`` written when they are due. ``events``: customer, event_id, moment, kind."""
    spark = events.sparkSession
    known = events.filter(F.col("customer").isNotNull() & F.col("moment").isNotNull()).withColumn("at_micros", F.unix_micros("moment")).withWatermark("moment", late)
    messages = known.groupBy("customer").transformWithStateInPandas(Waiting(rules), MESSAGE, "Append", "eventTime")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # timers and map state need it; a query keeps the setting it was started with
    try:
        out = messages.select("customer", "rule", "event_id", F.timestamp_micros("at_micros").alias("moment"), F.timestamp_micros("due_micros").alias("due"))
        return appended(out, target, checkpoint)
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
