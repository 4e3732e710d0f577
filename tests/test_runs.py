"""Clusters kept up to date and runs from seed to store, against doing everything at once."""

import random

import pytest
from pyspark.sql import functions as F

from waymark.operators import clusters, matching
from waymark.operators.records import upsert
from waymark.runs import Run, Settings
from waymark.runtime import new_folder

SCHEMA = "id string, name string, latitude double, longitude double, rank long"


def places(n, seed, dense=0.004):
    rng = random.Random(seed)
    words = ["blue", "door", "cafe", "roast", "bean"]
    out = []
    for i in range(n):
        name = " ".join(rng.sample(words, rng.randint(3, 4))) if rng.random() < 0.95 else "--"
        out.append((f"p{i}", name, 23.78 + round(rng.random() * dense, 4), 90.41 + round(rng.random() * dense, 4), i * 10 + rng.randint(0, 9)))
    ranks = [r for *_, r in out]
    rng.shuffle(ranks)
    return [(*p[:4], r) for p, r in zip(out, ranks, strict=True)]


def leaders(spark, spots, table):
    spot = clusters.spot_of(F.col("id"), F.col("name"), F.col("latitude"), F.col("longitude"))
    joined = spark.createDataFrame(table, SCHEMA).select("id", spot.alias("spot")).join(spots.select("spot", "leader_id", "leader_rank"), "spot")
    return {r["id"]: (r["leader_id"], r["leader_rank"]) for r in joined.collect()}


def whole(spark, table):
    return {r["id"]: (r["leader_id"], r["leader_rank"]) for r in matching.cluster_duplicates(spark.createDataFrame(table, SCHEMA)).collect()}


@pytest.mark.parametrize("seed", [1])
def test_increments_equal_clustering_at_once(spark, seed):
    table = places(160, seed)
    random.Random(seed).shuffle(table)
    cuts = [0, 140, 160]
    state = clusters.no_spots(spark, spark.createDataFrame(table, SCHEMA))
    for lo, hi in zip(cuts, cuts[1:]):
        fresh = clusters.reclustered(state, spark.createDataFrame(table[lo:hi], SCHEMA))
        state = upsert(state, fresh, "spot").checkpoint()
        assert leaders(spark, state, table[:hi]) == whole(spark, table[:hi])


def test_an_increment_touches_its_chain_alone(spark):
    far = [(f"q{i}", "blue door cafe", 24.0 + i * 0.01, 90.0, 1000 + i) for i in range(50)]
    # A chain a - b - c - d: each is near the next one only.
    chain = [(k, "green door cafe", 23.0 + i * 0.001, 90.0, 100 + i * 10) for i, k in enumerate("abcd")]
    table = far + chain
    first = clusters.reclustered(clusters.no_spots(spark, spark.createDataFrame(table, SCHEMA)), spark.createDataFrame(table, SCHEMA)).checkpoint()
    before = leaders(spark, first, table)
    assert [before[k][0] for k in "abcd"] == ["a", "a", "c", "c"]
    # An earlier one near a: a no longer leads, so b does, c does not, d does.
    new = [("z", "green door cafe", 22.999, 90.0, 1)]
    changed = clusters.reclustered(first, spark.createDataFrame(new, SCHEMA)).checkpoint()
    assert {r["id"]: r["leader_id"] for r in changed.collect()} == {"z": "z", "a": "z", "b": "b", "c": "b", "d": "d"}
    # A later one, one that is there already, and one at a known spot change no other.
    for row, touched in ((("y", "green door cafe", 23.0005, 90.0, 500), {"y"}), (far[7], set()), (("x", "cafe door blue", 24.0, 90.0, 5000), set())):
        assert {r["id"] for r in clusters.reclustered(first, spark.createDataFrame([row], SCHEMA)).collect()} == touched
    # One that comes before the head of its spot moves the spot.
    moved = clusters.reclustered(first, spark.createDataFrame([("w", "cafe green door", 23.001, 90.0, 50)], SCHEMA)).checkpoint()
    assert {r["id"]: r["leader_id"] for r in moved.collect()} == {"w": "w", "a": "w", "c": "w", "d": "d"}


SEED = "place_code string, business_name string, latitude double, longitude double, address string, area string, sub_area string, sub_type string, popularity double, pos long"
CAPTURED = "place_code string, confidence string, status string, fetched_at string, address string, rating double, review_count long, reviews array<string>, hours string, business_status string"


def seed_table(n):
    names = ["Blue Door Cafe", "Green Door Roastery", "Bean House", "Tea Corner Gulshan"]
    out = []
    for i in range(n):
        # Every seventh place is another's duplicate, every ninth out of scope.
        j = i - 1 if i % 7 == 3 else i
        out.append((f"c{i:03d}", f"{names[j % 4]} branch number{j % 50}", 23.78 + j * 0.002, 90.41, f"House {i}", "Gulshan" if i % 9 else "Mirpur", "Gulshan 1" if i % 9 else "Mirpur", "Cafe", float(i % 5), i))
    return out


def captured(n):
    ok = lambda i: ("high", "ok", f"2024-01-{1 + i % 28:02d}", f"Road {i}", 4.5, 10 + i, ["nice"], "Sat 10-22", "OPERATIONAL")
    partly = lambda i: ("low", "ok", f"2024-01-{1 + i % 28:02d}", "", 0.0, None, [], None, "UNKNOWN")
    missed = lambda i: ("low", "not_found", f"2024-01-{1 + i % 28:02d}", "never", 1.0, 1, ["x"], "x", "x")
    return [(f"c{i:03d}", *(ok, ok, partly, missed)[i % 4](i)) for i in range(n) if i % 11]


def stored(run, *without):
    return {r["place_code"]: {k: v for k, v in r.asDict().items() if k not in ("run_at", *without)} for r in run.records.read().collect()}


def test_two_runs_equal_one(spark):
    n, settings = 60, Settings(attempts=1)
    seed, visits = spark.createDataFrame(seed_table(n), SEED), spark.createDataFrame(captured(n), CAPTURED)
    once = Run(spark, new_folder(spark), settings, buckets=4)
    once.take(seed, visits, 0, "t")
    twice = Run(spark, new_folder(spark), settings, buckets=4)
    # c003 is a duplicate of c002, which the first run has taken; the others are new.
    twice.take(seed.filter("pos not in (3, 57, 58, 59)"), visits, 0, "t")
    before = stored(twice)
    version = twice.take(seed, visits, 1, "u")
    assert stored(twice, "cafe_id", "duplicate_of") == stored(once, "cafe_id", "duplicate_of") and len(stored(once)) == n
    # What did not change was not written again, and a run that is given again changes nothing.
    changed = {r["place_code"] for r in twice.records.read().filter("run_at = 'u'").collect()}
    assert changed == {k for k, v in stored(twice).items() if before.get(k) != v} and len(changed) == 4
    assert twice.take(seed, visits, 1, "u") == version == twice.records.versions()[-1]
    rows = stored(once)
    assert rows["c009"]["scrape_status"] == "out_of_scope" and rows["c009"]["leader_code"] is None
    assert rows["c010"]["leader_code"] == "c010" and rows["c003"]["duplicate_of"] == rows["c002"]["cafe_id"]
    assert rows["c003"]["rating"] == rows["c002"]["rating"] and rows["c005"]["rating"] == 4.5
    assert sorted(r["cafe_id"] for r in rows.values())[:2] == ["GUL-001", "GUL-002"] and len({r["cafe_id"] for r in rows.values()}) == n
    summary = once.summary().head().asDict()
    assert summary["records_total"] == n and summary["duplicates"] == sum(r["duplicate_of"] is not None for r in rows.values())
    assert summary["excluded"] == sum(r["duplicate_of"] is not None or r["scrape_status"] == "out_of_scope" for r in rows.values())


def test_attempts_limits_and_earlier_payloads(spark):
    n = 24
    seed, visits = spark.createDataFrame(seed_table(n), SEED), spark.createDataFrame(captured(n), CAPTURED)
    run = Run(spark, new_folder(spark), Settings(attempts=2, limit=10), buckets=2)
    run.fold_in(seed, visits.filter("status = 'ok'").drop("confidence", "status"), 0, "t")
    first = stored(run)
    assert first["c001"]["scrape_status"] == "legacy" and first["c001"]["attempts"] == 0 and first["c001"]["rating"] == 4.5
    run.take(seed, visits, 1, "u")
    second = stored(run)
    # Ten leaders in order of the seed, their duplicates with them; a visit that finds nothing leaves what was there.
    assert {r["attempts"] for r in second.values()} == {0, 1} and second["c001"]["attempts"] == 1 and second["c023"]["attempts"] == 0
    assert second["c007"]["scrape_status"] == "not_found" and second["c007"]["rating"] is None
    for number in range(2, 4):
        run.take(seed, visits, number, "v")
    third = stored(run)
    assert max(r["attempts"] for r in third.values()) == 2 and third["c001"]["attempts"] == 1
    run.forget(keep=1)
    assert run.records.versions()[-1] == 4 and stored(run) == third
