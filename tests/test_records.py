"""Records, stores, settings, pages and guards."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waymark.functions import hours
from waymark.operators import records, resolution
from waymark.sources import registry, sinks, tables, web
from waymark.streaming.guard import Breaker


def test_refresh_keeps_what_a_later_payload_lacks(spark):
    old = spark.createDataFrame([("A", "old address", 4.0, ["r"], 1)], "place_code string, address string, rating double, reviews array<string>, attempts long")
    pay = lambda *row: spark.createDataFrame([row], "place_code string, confidence string, status string, fetched_at string, address string, rating double, reviews array<string>")
    first = records.refresh(old, pay("A", "high", "ok", "t", "", 4.5, [])).first()
    assert (first.address, first.rating, first.reviews, first.attempts) == ("old address", 4.5, ["r"], 2)
    failed = records.refresh(old, pay("A", "low", "not_found", "t", "new", 1.0, ["x"])).first()
    assert (failed.address, failed.rating, failed.reviews) == ("old address", 4.0, ["r"])


def test_ids_are_stable(spark):
    rows = spark.createDataFrame([("A", 0), ("B", 1)], "place_code string, pos long")
    none = spark.createDataFrame([], "place_code string, cafe_id string")
    first = records.assign_ids(rows, none)
    assert {r.place_code: r.cafe_id for r in first.collect()} == {"A": "GUL-001", "B": "GUL-002"}
    more = spark.createDataFrame([("C", 2), ("A", 0), ("B", 1)], "place_code string, pos long")
    assert {r.place_code: r.cafe_id for r in records.assign_ids(more, first).collect()}["C"] == "GUL-003"


def test_resolution_of_an_empty_table(spark):
    blocks = spark.createDataFrame([], "place_code string, src string, rating double")
    assert resolution.resolve(blocks, ["rating"]).count() == 0


def test_hours_need_five_days(spark):
    week = {d: "closed" for d in hours.WEEK}
    rows = [("A", "g", {"Sat": "closed"}), ("A", "fp", week)]
    df = spark.createDataFrame(rows, "place_code string, src string, opening_hours map<string,string>")
    assert resolution.resolve(df, ["opening_hours"]).first().opening_hours_source == "fp"


def test_settings_merge():
    got = tables.merged_settings({"a": {"b": 1, "c": [1, 2]}, "d": 0}, {"a": {"c": [3]}, "e": 5})
    assert got == {"a": {"b": 1, "c": [3]}, "d": 0, "e": 5}
    assert tables.selectors({"t": ["h1"], "u": ["p"]}, {"t": ["h2"], "u": []}) == {"t": ["h2"], "u": ["p"]}


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿place_code,name\n1,\"a \"\"b\"\"\nc\"\n".encode())
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["place_code", "name"] and df.first().name == 'a "b"\nc'


def test_interrupted_replacement_is_readable(spark, tmp_path):
    at = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), f"{at}.bak")
    assert sinks.read_table(spark, at).count() == 3


def test_jsonld_takes_the_last_children_first():
    page = '<script type="application/ld+json">{"n": 0, "a": {"n": 1}, "b": [{"n": 2}, {"n": 3}]}</script><script>{"n": 9}</script>'
    assert [n["n"] for n in web.jsonld_nodes(page)] == [0, 3, 2, 1]


def test_block_page_reads_6000_characters(spark):
    body = "x" * 5995 + " captcha"
    reason = lambda b: spark.range(1).select(web.block_reason(F.lit(""), F.lit(b)).alias("r")).first().r
    assert reason(body) is None and reason("x" * 200 + " captcha").hard


def test_breaker_opens_cools_and_resets():
    b, t = Breaker(2, 600), datetime(2024, 1, 1)
    at = lambda s: t + timedelta(seconds=s)
    assert [b.event(at(s), f)[0] for s, f in ((0, True), (1, False), (2, True), (3, True), (100, False), (603, True), (604, True))] == ["failed", "ok", "failed", "opened", "skipped", "failed", "opened"]
    assert b.cooling_s(at(700)) == 504.0


def weeks(spark, rules, **options):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rules)], "i int, r string")
    return [r[0] for r in df.orderBy("i").select(hours.osm_hours(F.col("r"), **options)).collect()]


def test_osm_hours_never_fail(spark):
    rng = random.Random(3)
    parts = ["Mo", "Tu-Sa", "Fr-Mo", "PH", "XX-Mo", "off", "closed", "10:00-12:00", "9:30 - 24:00", "24/7", ",", ", ", ";", "; ", " ", "-", ":", "5", "o", "/"]
    for week in weeks(spark, ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(500)]):
        assert set(week) <= set(hours.WEEK_ISO)


def test_osm_hours_wrap_and_replace(spark):
    a, b, c, d, e, f, g = weeks(spark, ["Sa-Mo 10:00-12:00; Su off", "Mo-Su 08:00-22:00; PH off", "Mo, We-Th 9:00 - 24:00, 1:00-2:00", "off", "Tu open 10:00-11:00; Mo,PH 0:30-1:00", "Mo 10:00; 24/7; Sa Closed", "xyz 10:00-11:00"])
    assert set(a) == {"mon", "sat", "sun"} and a["sun"] == "Closed"
    assert set(b.values()) == {"8:00 AM – 10:00 PM"} and len(b) == 7
    assert c == dict.fromkeys(("mon", "wed", "thu"), "9:00 AM – 12:00 AM, 1:00 AM – 2:00 AM")
    assert d == dict.fromkeys(hours.WEEK_ISO, "Closed")
    assert e == {"mon": "12:30 AM – 1:00 AM", "tue": "10:00 AM – 11:00 AM"}
    assert f == dict.fromkeys(hours.WEEK_ISO, "Open 24 hours") | {"sat": "Closed"}
    assert g == dict.fromkeys(hours.WEEK_ISO, "10:00 AM – 11:00 AM")
    (x,) = weeks(spark, ["Mo-Su 08:00-22:00; PH off"], holidays_close_all=True)
    assert set(x.values()) == {"Closed"}


def test_brands_are_taken_literally():
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE SCHEMA public; CREATE TABLE public.places AS SELECT * FROM (VALUES ('100% Tea'), ('1000 Teas'), ('a_b'), ('axb'), ('it''s AGORA'), ('c\\d')) t(business_name)")
    found = lambda brand: sorted(r[0] for r in con.sql(tables.outlets_query(brand)).fetchall())
    assert found("100%") == ["100% Tea"] and found("A_B") == ["a_b"] and found("it's agora") == ["it's AGORA"] and found("c\\D") == ["c\\d"] and len(found("")) == 6


def test_sources_keep_a_contract(spark):
    good = spark.sql("SELECT 'a' AS place_code, 'g' AS src, 'ok' AS status, timestamp'2024-01-01' AS ts, 1 AS rating")
    other = spark.sql("SELECT 'b' AS place_code, 'osm' AS src, 'ok' AS status, timestamp'2024-01-01' AS ts, 'x' AS website")
    source = lambda name, df, **more: registry.Source(name, lambda *_: df, **more)
    both = registry.observations([source("g", good), source("osm", other), source("off", good.drop("ts"), enabled=False)], spark, "")
    assert sorted((r.place_code, r.rating, r.website) for r in both.collect()) == [("a", 1, None), ("b", None, "x")]
    for broken in ([source("g", good.drop("ts"))], [source("g", good.withColumn("ts", F.lit("x")))], [source("g", good), source("g", other)], []):
        with pytest.raises(registry.BrokenContract):
            registry.observations(broken, spark, "")


def test_a_walk_of_pages_ends_and_its_plan_does_not_grow(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "url string, next_url string")
    start = spark.createDataFrame([("a",)], "url string")
    walked = web.pages_from(start, links, 50)
    assert sorted(map(tuple, walked.collect())) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert web.pages_from(start, links, 10)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
