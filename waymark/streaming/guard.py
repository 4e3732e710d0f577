"""Daily quotas, gaps and blocks over request events, and one host's breaker request by request."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEPT_DAYS = 14
STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state in RocksDB, which state with timers needs."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


def newest_days(used: DataFrame, kept_days: int = KEPT_DAYS) -> DataFrame:
    """Rows (day, ...) of the newest days that there are."""
    days = used.select("day").distinct().orderBy(F.desc("day")).limit(kept_days)
    return used.join(F.broadcast(days), "day", "left_semi")


def spend(events: DataFrame, host: str = "host", ts: str = "ts", kept_days: int = KEPT_DAYS) -> DataFrame:
    """(day, host, used) of the newest days that have events."""
    return newest_days(events.groupBy(F.to_date(ts).alias("day"), F.col(host).alias("host")).agg(F.count("*").alias("used")), kept_days)


def remaining(used: DataFrame, cap: Column) -> DataFrame:
    return used.withColumn("remaining", F.greatest(F.lit(0).cast("long"), cap - F.col("used")))


def within_quota(events: DataFrame, cap: Column, unique: str, host: str = "host", ts: str = "ts") -> DataFrame:
    """Adds ``allowed``: the event is among the first ``cap`` of its host and day."""
    w = Window.partitionBy(host, F.to_date(ts)).orderBy(ts, unique)
    return events.withColumn("allowed", F.row_number().over(w) <= cap)


def since_last(events: DataFrame, unique: str, host: str = "host", ts: str = "ts") -> DataFrame:
    """Adds ``gap_us`` to the host's event before."""
    before = F.lag(ts).over(Window.partitionBy(host).orderBy(ts, unique))
    return events.withColumn("gap_us", F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(before.cast("timestamp")))


def before_hard_block(events: DataFrame, hard: Column, unique: str, host: str = "host", ts: str = "ts") -> DataFrame:
    """Events up to and with the first hard block of their host; the rest of the run is off. The first block of each host is an
    aggregate over blocks alone; a host of any share of the events is joined to it, not brought together."""
    at = F.struct(ts, unique)
    first = events.filter(hard).groupBy(F.col(host).alias("_host")).agg(F.min(at).alias("_first"))
    joined = events.join(first, F.col(host).eqNullSafe(F.col("_host")), "left")
    return joined.filter(F.col("_first").isNull() | (at <= F.col("_first"))).drop("_host", "_first")


class Breaker:
    """Opens after ``threshold`` failures in a row, for ``cooldown``; a success or the end of the cooldown resets it."""

    def __init__(self, threshold: int = 2, cooldown_s: float = 600.0, fails: int = 0, until: datetime | None = None):
        self.threshold, self.cooldown, self.fails, self.until = threshold, timedelta(seconds=cooldown_s), fails, until

    def event(self, at: datetime, failed: bool) -> tuple[str, int]:
        """(decision, failures so far): skipped while open, else failed, opened or ok."""
        if self.until is not None:
            if at < self.until:
                return "skipped", self.fails
            self.fails, self.until = 0, None
        if not failed:
            self.fails = 0
            return "ok", 0
        self.fails += 1
        if self.fails >= self.threshold:
            self.until = at + self.cooldown
            return "opened", self.fails
        return "failed", self.fails

    def cooling_s(self, at: datetime) -> float:
        return max(0.0, (self.until - at).total_seconds()) if self.until else 0.0
