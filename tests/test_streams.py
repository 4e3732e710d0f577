"""Breakers, quotas and ledgers over several micro-batches with restarts; versions of tables with rival writers."""

import gc
import os
import threading
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.runtime import checkpoint_folder, frozen, new_folder
from waymark.sources.snapshots import Conflict, Files, Snapshots
from waymark.streaming import breaker, guard, quota

T0 = datetime(2024, 1, 1)
REQUEST = "event_id long, host long, ts timestamp, failed boolean"


def rows(df):
    return [tuple(r) for r in df.collect()]


HISTORY = st.lists(st.tuples(st.integers(0, 4), st.booleans()), min_size=1, max_size=14)


@given(st.integers(1, 4), st.integers(1, 12), st.lists(st.tuples(HISTORY, st.one_of(st.none(), st.integers(0, 15)), st.integers(0, 3)), min_size=1, max_size=4))
@settings(max_examples=400, deadline=None)
def test_decisions_equal_those_taken_one_by_one(threshold, cooldown, hosts):
    starts, ts, failed, before, want, after, closed = [], [], [], [], [], [], []
    for h, (history, until, fails) in enumerate(hosts):
        fails = threshold if until is not None else min(fails, threshold - 1)
        one = guard.Breaker(threshold, cooldown / 1e6, fails, None if until is None else T0 + timedelta(microseconds=until))
        before.append((fails, breaker.NEVER if until is None else until))
        starts.append(len(ts))
        at = 0
        for step, bad in history:
            at, was = at + step, one.until
            ts.append(at)
            failed.append(bad)
            want.append(one.event(T0 + timedelta(microseconds=at), bad))
            if was is not None and want[-1][0] != "skipped":
                closed.append((h, (was - T0) // timedelta(microseconds=1)))
        after.append((one.fails, breaker.NEVER if one.until is None else (one.until - T0) // timedelta(microseconds=1)))
    state = breaker.Breakers(*(np.array(x) for x in zip(*before, strict=True)))
    d = breaker.decisions(np.array(starts), np.array(ts), np.array(failed), state, threshold, cooldown)
    assert list(zip(breaker.SAYS[d.says].tolist(), d.fails.tolist(), strict=True)) == want
    assert list(zip(d.after.fails.tolist(), d.after.until.tolist(), strict=True)) == after
    assert sorted(zip(*(x.tolist() for x in d.closed), strict=True)) == sorted(closed)


def test_batches_take_odd_requests(spark):
    table = [(1, 1, None, True), (2, 1, T0, True), (3, 1, T0, None), (4, None, T0, True), (5, None, T0, True), (6, None, T0 + timedelta(hours=1), True), (2, 1, T0, True)]
    got = sorted(rows(breaker.breaker_batch(spark.createDataFrame(table, REQUEST), 2, 60)), key=str)
    assert got == sorted([(1, 1, "failed", 1), (2, 1, "opened", 2), (2, 1, "skipped", 2), (3, 1, "skipped", 2), (4, None, "failed", 1), (5, None, "opened", 2), (6, None, "failed", 1)], key=str)
    assert rows(breaker.breaker_batch(spark.createDataFrame([], REQUEST))) == []


def test_a_host_over_many_chunks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = [(i, i % 3, T0 + timedelta(minutes=i), i % 7 < 4) for i in range(300)]
        got = {r[0]: r[2:] for r in rows(breaker.breaker_batch(spark.createDataFrame(table, REQUEST), 3, 1200))}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    for h in range(3):
        one = guard.Breaker(3, 1200)
        for i, _, ts, failed in (r for r in table if r[1] == h):
            assert got[i] == one.event(ts, failed)


class Runs:
    """A stream that is stopped after each micro-batch and goes on from its checkpoint."""

    def __init__(self, spark, make, schema=REQUEST):
        self.spark, self.make, self.schema, self.at, self.out = spark, make, schema, new_folder(spark), []

    def take(self, table):
        self.spark.createDataFrame(table, self.schema).coalesce(1).write.mode("append").parquet(f"{self.at}/in")
        got = []
        with guard.stateful(self.spark):
            stream = self.make(self.spark.readStream.schema(self.schema).parquet(f"{self.at}/in"))
            run = stream.writeStream.foreachBatch(lambda df, i: got.extend(rows(df))).option("checkpointLocation", f"{self.at}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        self.out += got
        return got

    def state(self, name):
        return rows(self.spark.read.format("statestore").option("stateVarName", name).load(f"{self.at}/state").select("key.*"))


def hours(n):
    return T0 + timedelta(hours=n)


def test_breaker_stream_with_restarts_timers_and_expiry(spark):
    runs = Runs(spark, lambda s: breaker.breaker_stream(s, 2, 3600, late="1 hour"))
    assert [r[2:4] for r in sorted(runs.take([(1, 7, hours(0), True), (2, 7, hours(0.5), True), (3, 8, hours(0.5), True)]), key=str)] == [("failed", 1), ("opened", 2), ("failed", 1)]
    # The failure of host 8 is remembered; host 7 cools, and has no further request.
    assert sorted((r[0], r[2]) for r in runs.take([(4, 7, hours(1), False), (5, 8, hours(1), True)])) == [(4, "skipped"), (5, "opened")]
    # Event time passes both cooldowns: timers close them.
    third = runs.take([(6, 9, hours(6), False)])
    assert sorted((r[1], r[2], r[4]) for r in third if r[0] is None) == [(7, "closed", hours(1.5)), (8, "closed", hours(2))]
    assert sorted(runs.state("breaker")) == [(7,), (8,), (9,)]
    # Requests of host 7 count anew; those older than the watermark get no decision.
    assert [(r[0], r[2], r[3]) for r in runs.take([(7, 7, hours(6.5), True), (8, 7, hours(1), True)])] == [(7, "failed", 1)]
    # Two weeks on, hosts without requests have left the state.
    runs.take([(9, 9, hours(24 * 30), False)])
    assert runs.state("breaker") == [(9,)]


def test_breaker_stream_goes_on_from_given_breakers(spark):
    us = lambda t: int((t - T0).total_seconds() * 1e6) + 1_704_067_200_000_000
    initial = spark.createDataFrame([(1, 1, None, us(hours(0))), (2, 2, us(hours(5)), us(hours(0)))], "host long, fails long, until long, last long")
    runs = Runs(spark, lambda s: breaker.breaker_stream(s, 2, 3600, initial=initial))
    got = runs.take([(1, 1, hours(1), True), (2, 2, hours(1), False), (3, 2, hours(6), True)])
    assert sorted((r[0] or 0, r[1], r[2], r[3]) for r in got) == [(0, 2, "closed", 0), (1, 1, "opened", 2), (2, 2, "skipped", 2), (3, 2, "failed", 1)]


def test_quota_stream_with_late_and_repeated_requests(spark):
    runs = Runs(spark, lambda s: quota.quota_stream(s, F.lit(2), late="2 hours"))
    day = T0.date()
    first = runs.take([(1, 7, hours(1), False), (1, 7, hours(1), False), (2, 7, hours(2), False), (3, 8, hours(2), False)])
    assert sorted(r[:4] for r in first) == [(1, 7, day, True), (2, 7, day, True), (3, 8, day, True)]
    # 2 comes again, 4 is over the quota, 5 has not been late.
    second = runs.take([(2, 7, hours(2), False), (4, 7, hours(3), False), (5, 8, hours(2.5), False)])
    assert sorted((r[0], r[3], r[4]) for r in second) == [(4, False, 0), (5, True, 0)]
    third = runs.take([(6, 7, hours(30), False)])
    assert [(r[0], r[2], r[3]) for r in third] == [(6, day + timedelta(days=1), True)]
    # The first day is over and has left the state; a request of it comes too late.
    assert runs.state("used") == [(7, 19724)]
    assert [r[0] for r in runs.take([(7, 8, hours(3), False), (8, 8, hours(31), False)])] == [8]


def test_ledger_counts_a_batch_once(spark):
    store = Snapshots(spark, new_folder(spark), ["day", "host"], buckets=4)
    events = spark.createDataFrame([(i, i % 2, hours(i), False) for i in range(48)], REQUEST)
    sink = store.sink("spend", quota.spent, quota.daily)
    sink(events, 0)
    before = store.versions()
    sink(events, 0)
    assert store.versions() == before and sum(r[2] for r in rows(store.read())) == 48
    sink(events, 1)
    assert sorted(r[2] for r in rows(store.read())) == [24] * 4


# Versions ---------------------------------------------------------------------------------------------------------


@pytest.fixture
def store(spark):
    return Snapshots(spark, new_folder(spark), "k", buckets=5)


def table(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v long")


def test_versions_are_read_as_they_were(spark, store):
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.replace(table(spark, [(i, 0) for i in range(20)]), note={"location": "x"}) == 1
    assert store.upsert(table(spark, [(3, 1), (50, 1)])) == 2
    old = store.read(1)
    assert store.replace(table(spark, [(1, 9)]), base=2) == 3
    assert sorted(rows(old)) == [(i, 0) for i in range(20)]
    assert sorted(rows(store.read(2))) == sorted([(i, int(i == 3)) for i in range(20)] + [(50, 1)])
    assert rows(store.read()) == [(1, 9)] and store.commit()["note"] == {"location": "x"}
    with pytest.raises(Conflict):
        store.replace(table(spark, []), base=2)
    assert store.replace(table(spark, [])) == 4 and rows(store.read()) == [] and rows(store.read(3)) == [(1, 9)]


def test_an_upsert_leaves_other_buckets_alone(spark, store):
    store.replace(table(spark, [(i, 0) for i in range(50)]))
    store.upsert(table(spark, [(7, 1)]))
    old, new = store.commit(1)["parts"], store.commit(2)["parts"]
    assert sum(old[b] != new[b] for b in old) == 1 and old.keys() == new.keys()


def test_of_two_writers_one_wins(spark, store):
    store.replace(table(spark, [(i, 0) for i in range(20)]))
    made, lost = [], []

    def write(v):
        try:
            made.append(store.replace(table(spark, [(0, v)]), base=1))
        except Conflict:
            lost.append(v)

    threads = [threading.Thread(target=write, args=(v,)) for v in range(1, 4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert made == [2] and len(lost) == 2 and len(rows(store.read())) == 1


def test_upserts_of_rivals_are_all_there(spark, store):
    store.replace(table(spark, [(i, 0) for i in range(20)]))
    add = lambda old, new: old.unionByName(new).groupBy("k").agg(F.sum("v").alias("v"))
    threads = [threading.Thread(target=store.upsert, args=(table(spark, [(i, 1) for i in range(20)]), add)) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert store.versions() == [1, 2, 3, 4, 5] and sorted(rows(store.read())) == [(i, 4) for i in range(20)]


def test_a_crash_before_the_commit_leaves_the_old_version(spark, store, monkeypatch):
    store.upsert(table(spark, [(1, 1)]), stream="s", batch=0)
    with monkeypatch.context() as m:
        m.setattr(Files, "create", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.upsert(table(spark, [(2, 2)]), stream="s", batch=1)
    assert rows(store.read()) == [(1, 1)]
    # The stream gives the batch again.
    store.upsert(table(spark, [(2, 2)]), stream="s", batch=1)
    assert sorted(rows(store.read())) == [(1, 1), (2, 2)]
    assert len(store.vacuum(older_than_s=0)) == 1 and sorted(rows(store.read())) == [(1, 1), (2, 2)]


def test_vacuum_keeps_what_versions_need(spark, store):
    for i in range(6):
        store.upsert(table(spark, [(i % 3, i)]))
    assert store.vacuum(keep=2) == []
    assert store.versions() == [5, 6]
    store.vacuum(keep=2, older_than_s=0)
    assert sorted(rows(store.read(5))) == [(0, 3), (1, 4), (2, 2)] and sorted(rows(store.read())) == [(0, 3), (1, 4), (2, 5)]


@pytest.mark.parametrize("local", [True, False])
def test_a_file_is_made_once(spark, local):
    at = new_folder(spark)
    files = Files(spark, at)
    files.local = local
    made = []
    threads = [threading.Thread(target=lambda i=i: made.append((i, files.create(f"{at}/x", f"text {i}")))) for i in range(6 if local else 1)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winner = [i for i, ok in made if ok]
    assert len(winner) == 1 and files.read(f"{at}/x") == f"text {winner[0]}"
    assert files.create(f"{at}/x", "late") is False and list(files.names(at)) == ["x"]


def test_checkpoints_go_when_nothing_refers_to_them(spark):
    def files():
        return {f for top, _, names in os.walk(checkpoint_folder(spark).removeprefix("file:")) for n in names if "/rdd-" in (f := f"{top}/{n}")}

    before = files()
    table = frozen(spark.range(100))
    made = files() - before
    assert made and table.count() == 100
    del table
    for _ in range(40):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if not made & files():
            return
        time.sleep(0.5)
    raise AssertionError("files of a checkpoint are still there")
