"""Circuit breakers of hosts: the same decisions over a table and over a stream.

A breaker opens after ``threshold`` failures in a row and skips its host's requests until the cooldown has passed; a success
or the end of the cooldown resets it. Decisions are taken on columns: each step of the loop finds the next opening of
every host at once, so there are as many steps as one host has openings, not requests.

Over a stream a host's state is its failures so far, the end of its cooldown and its last request. A timer ends the
cooldown when event time passes it, with or without a further request, and another removes a host without requests for
KEPT_DAYS, so the state is as large as the hosts of that time. State can start from the breakers of an earlier run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: A host without requests for so many days leaves the state.
KEPT_DAYS = 14
NEVER = int(np.iinfo(np.int64).min)
#: What ``decisions`` numbers, in this order. A stream also tells when a cooldown is over ("closed", without a request).
SAYS = np.array(["ok", "failed", "opened", "skipped"], object)
OK, FAILED, OPENED, SKIPPED = range(4)
DAY_MS = 86_400_000


class Breakers(NamedTuple):
    """Failures so far of hosts, and in microseconds when their cooldowns end (NEVER: not cooling)."""

    fails: np.ndarray
    until: np.ndarray


class Decided(NamedTuple):
    """What was said of every request and the failures so far; the hosts' breakers after it; the cooldowns that ended by a later
    request of their host (host's number, end)."""

    says: np.ndarray
    fails: np.ndarray
    after: Breakers
    closed: tuple[np.ndarray, np.ndarray]


def decisions(starts: np.ndarray, ts: np.ndarray, failed: np.ndarray, before: Breakers, threshold: int, cooldown_us: int) -> Decided:
    """Decisions of requests in order of time; those of one host stand together and begin at ``starts``."""
    n = len(ts)
    ends, at = np.append(starts[1:], n), np.arange(n)
    host = np.repeat(np.arange(len(starts)), ends - starts)
    # The next success at or after a request, or its host's end; how many failures in a row end at a request.
    next_ok = np.minimum(np.minimum.accumulate(np.where(failed, n, at)[::-1])[::-1], ends[host])
    run = at - np.maximum(np.maximum.accumulate(np.where(failed, -1, at)), starts[host] - 1)
    enough = np.append(np.flatnonzero(run >= threshold), n)
    skip, held, anew = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n + 1, bool)
    closed: list[tuple[np.ndarray, np.ndarray]] = []

    def skipped(hosts: np.ndarray, first: np.ndarray, until: np.ndarray, fails: np.ndarray | int) -> np.ndarray:
        """Mark what is skipped from ``first`` on; the first request after it, where the count begins anew."""
        found = [lo + int(np.searchsorted(ts[lo:hi], t)) for lo, hi, t in zip(first.tolist(), ends[hosts].tolist(), until.tolist(), strict=True)]
        after = np.array(found, np.int64)
        for steps, by in ((skip, 1), (held, fails)):
            np.add.at(steps, first, by)
            np.subtract.at(steps, after, by)
        over = after < ends[hosts]
        anew[after[over]] = True
        closed.append((hosts[over], until[over]))
        return after

    says = np.where(failed, FAILED, OK)
    cooling = np.flatnonzero(before.until != NEVER)
    begin, carry, until = starts.copy(), np.where(before.until != NEVER, 0, before.fails), np.full(len(starts), NEVER)
    carried = carry.copy()
    begin[cooling] = skipped(cooling, starts[cooling], before.until[cooling], before.fails[cooling])
    still = cooling[begin[cooling] >= ends[cooling]]
    until[still] = before.until[still]
    going = np.flatnonzero(begin < ends)
    while len(going):
        lo = begin[going]
        soon = carry[going] + next_ok[lo] - lo >= threshold
        opens = np.where(soon, lo + threshold - carry[going] - 1, enough[np.searchsorted(enough[:-1], lo + threshold - 1)])
        there = opens < ends[going]
        going, opens = going[there], opens[there]
        says[opens] = OPENED
        shut = ts[opens] + cooldown_us
        begin[going], carry[going] = skipped(going, opens + 1, shut, threshold), 0
        over = begin[going] < ends[going]
        until[going] = np.where(over, NEVER, shut)
        going = going[over]
    # Failures in a row since the last success, or since the count began anew.
    since = np.maximum.accumulate(np.maximum(np.where(failed, -1, at), np.where(anew[:n], at - 1, -1)))
    since = np.maximum(since, starts[host] - 1)
    fresh = (since == starts[host] - 1) & ~anew[starts[host]]
    fails = np.where(failed, at - since + np.where(fresh, carried[host], 0), 0)
    out = np.cumsum(skip[:n]) > 0
    says[out] = SKIPPED
    fails = np.where(out, np.cumsum(held[:n]), fails)
    hosts, times = (np.concatenate(x) for x in zip(*closed, strict=True))
    return Decided(says, fails, Breakers(fails[ends - 1], until), (hosts, times))


def _timed(events: DataFrame, *more: str) -> DataFrame:
    """Narrow columns of requests, and more; one without a time counts as the first, one that tells nothing as a success."""
    return events.select("event_id", "host", F.coalesce(F.unix_micros("ts"), F.lit(-(1 << 62))).alias("us"), F.coalesce("failed", F.lit(False)).alias("failed"), *more)


def breaker_batch(events: DataFrame, threshold: int = 2, cooldown_s: float = 600.0) -> DataFrame:
    """(event_id, host, decision, fails): the breakers run over each host's events in order of time and id.

    Only four narrow columns of a host go to its task, and they are decided in sorted chunks, so a host's history need not
    fit into memory. A host's events are one sequence, each decision resting on the one before, so they are one task's
    work. ``events``: event_id, host, ts, failed.
    """
    rows = _timed(events).repartition("host").sortWithinPartitions("host", "us", "event_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, (0, NEVER)
        for batch in batches:
            if not batch.num_rows:
                continue
            host, us, failed = (batch.column(i).fill_null(f).to_numpy(zero_copy_only=False) for i, f in ((1, NEVER), (2, 0), (3, False)))
            starts = np.concatenate(([0], np.flatnonzero(host[1:] != host[:-1]) + 1))
            before = Breakers(np.zeros(len(starts), np.int64), np.full(len(starts), NEVER))
            if host[0] == last:
                before.fails[0], before.until[0] = kept
            d = decisions(starts, us, failed, before, threshold, int(cooldown_s * 1e6))
            last, kept = host[-1], (d.after.fails[-1], d.after.until[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(SAYS[d.says], pa.string()), pa.array(d.fails, pa.int32())], ["event_id", "host", "decision", "fails"])

    return rows.mapInArrow(run, "event_id long, host long, decision string, fails int")


class BreakerState(StatefulProcessor):
    """One host's breaker over micro-batches."""

    def __init__(self, threshold: int, cooldown_s: float, kept_days: int):
        self.threshold, self.cooldown_us, self.kept_ms = threshold, int(cooldown_s * 1e6), kept_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Failures, the end of the cooldown, and the last request, in microseconds.
        self.state = handle.getValueState("breaker", "fails long, until long, last long")

    def _keep(self, fails: int, until: int, last: int) -> None:
        """The state, with a timer for the end of the cooldown and one for the host's leaving."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.update((int(fails), int(until), int(last)))
        if until != NEVER:
            self.handle.registerTimer(-(-int(until) // 1000))
        self.handle.registerTimer(int(last) // 1000 + self.kept_ms)

    def _closed(self, host: int, times: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"event_id": pd.array([None] * len(times), "Int64"), "host": host, "decision": "closed", "fails": 0, "us": times})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        until = NEVER if pd.isna(row["until"]) else int(row["until"])
        self._keep(row["fails"], until, row["last"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fails, until, last = self.state.get() if self.state.exists() else (0, NEVER, 0)
        frame = pd.concat(list(rows)).sort_values(["us", "event_id"])
        us = frame["us"].to_numpy(np.int64)
        d = decisions(np.zeros(1, np.int64), us, frame["failed"].to_numpy(bool), Breakers(np.array([fails]), np.array([until])), self.threshold, self.cooldown_us)
        self._keep(d.after.fails[0], d.after.until[0], max(last, int(us[-1])))
        yield pd.DataFrame({"event_id": frame["event_id"].to_numpy(), "host": key[0], "decision": SAYS[d.says], "fails": d.fails, "us": us})
        if len(d.closed[1]):
            yield self._closed(key[0], d.closed[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = expiredTimerInfo.getExpiryTimeInMs()
        if self.state.exists():
            fails, until, last = self.state.get()
            if until != NEVER and until <= passed * 1000:
                yield self._closed(key[0], np.array([until]))
                fails, until = 0, NEVER
                self.state.update((fails, until, last))
            if last // 1000 + self.kept_ms <= passed:
                self.state.clear()

    def close(self) -> None:
        pass


def breaker_stream(events: DataFrame, threshold: int = 2, cooldown_s: float = 600.0, late: str = "1 day", kept_days: int = KEPT_DAYS, initial: DataFrame | None = None) -> DataFrame:
    """(event_id, host, decision, fails, at) over a stream: a decision for each request in the order they come in, by time and id
    within a micro-batch; and for each cooldown that is over a row "closed" without event_id, at its end.

    ``late``: how much later than the latest one a request may come; later ones are dropped, and timers wait that long.
    ``initial`` (host, fails, until, last: long, microseconds): breakers of an earlier run. The query needs a state store with
    timers, see ``stateful``. A host's requests of one micro-batch are held in memory, four narrow columns.
    """
    rows = _timed(events.withWatermark("ts", late), "ts")
    out = rows.groupBy("host").transformWithStateInPandas(
        BreakerState(threshold, cooldown_s, kept_days),
        "event_id long, host long, decision string, fails int, us long",
        "append",
        "eventTime",
        initialState=initial.groupBy("host") if initial is not None else None,
    )
    return out.select("event_id", "host", "decision", "fails", F.timestamp_micros("us").alias("at"))
