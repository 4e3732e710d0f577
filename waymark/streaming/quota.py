"""Daily quotas of hosts over a stream: a decision for every request, and the spend of every day."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from waymark.sources.snapshots import Snapshots

from .breaker import DAY_MS


class QuotaState(StatefulProcessor):
    """Requests of one host and day that were allowed; forgotten once event time has passed the day."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("used", "used long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["us", "event_id"])
        if self.state.exists():
            (used,) = self.state.get()
        else:
            used = 0
            self.handle.registerTimer((int(frame["day_number"].iloc[0]) + 1) * DAY_MS)
        n, cap = len(frame), int(frame["cap"].iloc[0])
        allowed = used + np.arange(1, n + 1) <= cap
        used = max(used, min(used + n, cap))
        self.state.update((used,))
        yield pd.DataFrame({"event_id": frame["event_id"].to_numpy(), "host": key[0], "day_number": key[1], "allowed": allowed, "remaining": max(0, cap - used)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def once(events: DataFrame, late: str = "1 day") -> DataFrame:
    """A stream without requests that come again within ``late`` of their time; ids older than that leave the state."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def quota_stream(events: DataFrame, cap: Column, late: str = "1 day") -> DataFrame:
    """(event_id, host, day, allowed, remaining) of every request in a stream of event_id, host, ts: whether it is among the first
    ``cap`` of its host and day (in UTC), in the order they come in, by time and id within a micro-batch; and what the
    micro-batch leaves of the quota.

    A request that comes again within ``late`` of its time is one request, and gets no second decision; one that is later
    than the latest by more than that gets none. A day leaves the state when event time has passed it by ``late``. Needs a
    state store with timers, see ``stateful``.
    """
    us = F.unix_micros("ts")
    rows = once(events, late).select("event_id", "host", us.alias("us"), F.floor(us / (DAY_MS * 1000)).cast("long").alias("day_number"), cap.cast("long").alias("cap"), "ts")
    out = rows.groupBy("host", "day_number").transformWithStateInPandas(QuotaState(), "event_id long, host long, day_number long, allowed boolean, remaining long", "append", "eventTime")
    return out.select("event_id", "host", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day_number").cast("int")).alias("day"), "allowed", "remaining")


def daily(events: DataFrame) -> DataFrame:
    """(day, host, used) of a micro-batch of requests, or of a table."""
    return events.groupBy(F.to_date("ts").alias("day"), "host").agg(F.count("*").alias("used"))


def spent(old: DataFrame, new: DataFrame) -> DataFrame:
    """The spend of (day, host) in either, added up: folds a micro-batch's into a ledger."""
    return old.unionByName(new).groupBy("day", "host").agg(F.sum("used").alias("used"))


def ledger(events: DataFrame, store: Snapshots, stream: str = "spend", late: str = "1 day") -> DataStreamWriter:
    """A writer that keeps the daily spend per host of a stream of requests in ``store`` (key: day, host). The stream's own state
    are the ids of ``late``; a micro-batch that comes again after a failure is not counted twice."""
    return once(events, late).writeStream.outputMode("append").foreachBatch(store.sink(stream, spent, daily))
