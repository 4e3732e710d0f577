"""Vectors of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from waymark.functions import dates, hours, numbers, text, values
from waymark.operators import matching


def one(spark, column, kind="string", value=None):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "raw, value, approximate",
    [("2116", 2116, False), ("1,234", 1234, False), ("1.2K", 1200, True), ("1.2k reviews", 1200, True), ("3M", 3_000_000, True), ("N/A", None, False), (None, None, False)],
)
def test_parse_count(spark, raw, value, approximate):
    assert tuple(one(spark, numbers.parse_count, value=raw)) == (value, approximate)


@pytest.mark.parametrize("raw, value", [("4.6", 4.6), ("4,6 stars", 4.6), ("5.7", None), ("0", None), ("no rating", None)])
def test_parse_rating(spark, raw, value):
    assert one(spark, numbers.parse_rating, value=raw) == value


@pytest.mark.parametrize("raw, value", [("01939899573", "+8801939899573"), ("+880 1841-552898", "+8801841552898"), ("02 8834567", "+88028834567"), ("N/A", None), (None, None)])
def test_phone(spark, raw, value):
    assert one(spark, text.norm_bd_phone, value=raw) == value


@pytest.mark.parametrize("raw, value", [("https://x.com/a/?utm=1#frag", "https://x.com/a"), ("not a url", None), ("N/A", None), (None, None)])
def test_clean_url(spark, raw, value):
    assert one(spark, text.clean_url, value=raw) == value


@pytest.mark.parametrize("raw, value", [("N/A", True), (" ", True), (None, True), ("0", False)])
def test_is_empty(spark, raw, value):
    assert one(spark, values.is_empty, value=raw) is value


def test_name_match(spark):
    score = lambda a, b: one(spark, lambda c: text.name_match(c, F.lit(b)), value=a)
    assert score("Coffee Buzz", "coffee buzz") == 1.0
    assert score("2 Bros Cafe", "North End Coffee Roasters") < 0.34
    assert 0.5 < score("Coffee Buzz Gulshan", "Coffee Buzz") < 1
    assert score("X Cafe Gulshan 1", "X Cafe Gulshan 2") == 1.0
    assert score("", "x") == 0.0


@pytest.mark.parametrize(
    "raw, value",
    [
        ("9 AM–10 PM", "09:00-22:00"), ("9:30 AM–10:30 PM", "09:30-22:30"), ("12–1:30 PM", "12:00-13:30"), ("5–7 PM", "17:00-19:00"), ("8 AM–12:45 AM", "08:00-00:45"),
        ("Open 24 hours", "00:00-24:00"), ("24 hours", "00:00-24:00"), ("Closed", "closed"), ("5–7 PM, 8–10 PM", "17:00-19:00, 20:00-22:00"), ("10:00-22:00", "10:00-22:00"),
        ("", None), ("N/A", None), ("N/A (Check Maps)", None), ("Check Maps", None), ("Bakery", None), ("9 AM-10 PM-3 PM", None), (None, None), ("11–1 PM", "23:00-13:00"),
    ],
)
def test_canonical_hours(spark, raw, value):
    assert one(spark, hours.canonical_hours, value=raw) == value


def test_hours_in_text(spark):
    week = "Hours: Saturday 1–11 PM; Sunday Closed; Monday 9 AM–10 PM; Tuesday 9 AM–10 PM; Wednesday 9 AM–10 PM; Thursday 9 AM–10 PM; Friday, 1–11 PM"
    got = one(spark, hours.hours_in_text, value=week)
    assert len(got) == 7 and got["Fri"] == "13:00-23:00" and got["Sun"] == "closed"
    assert one(spark, hours.hours_in_text, value="Hours: Open now") == {} == one(spark, hours.hours_in_text, value=None)


def test_normalized_hours(spark):
    f = lambda d: one(spark, hours.normalized_hours, "map<string,string>", d)
    assert f({"monday": "9 AM–10 PM", "sat": "Closed", "fri": "Open 24 hours"}).schedule == {"Sat": "closed", "Mon": "09:00-22:00", "Fri": "00:00-24:00"}
    raw = f({"mon": "ask at counter"})
    assert raw.schedule == {"Mon": "ask at counter"} and len(raw.notes) == 1
    assert f({"sat": "N/A", "sun": ""}).schedule == {}


@pytest.mark.parametrize(
    "raw, value", [("3 months ago", "2026-06-22"), ("a month ago", "2026-08-21"), ("an hour ago", "2026-09-19"), ("yesterday", None), (None, None)]
)
def test_relative_time(spark, raw, value):
    anchor = F.to_timestamp(F.lit("2026-09-20 00:30:00"))
    day = one(spark, lambda c: dates.relative_time(c, anchor), value=raw).day
    assert (day and day.isoformat()) == value


@pytest.mark.parametrize("raw, value", [("00:00", "12:00 AM"), ("12:00", "12:00 PM"), ("24:00", "12:00 AM"), ("x", "x")])
def test_ampm(spark, raw, value):
    assert one(spark, hours.hhmm_to_ampm, value=raw) == value


@pytest.mark.parametrize(
    "score, distance, want",
    [
        (1.0, None, ("low", "no_match")), (1.0, 1200.1, ("low", "geo_mismatch")), (0.6, 300.0, ("high", "ok")), (0.6, 300.1, ("medium", "ok")),
        (0.4, 800.0, ("medium", "ok")), (0.44, 801.0, ("low", "geo_mismatch")), (0.45, 1200.0, ("low", "ok")), (0.39, 0.0, ("low", "geo_mismatch")),
    ],
)
def test_classify(spark, score, distance, want):
    df = spark.createDataFrame([(score, distance)], "s double, d double")
    assert tuple(df.select(matching.classify(F.col("s"), F.col("d")).alias("m")).first().m) == want


def test_clusters_follow_heads_only(spark):
    place = lambda id_, lat, rank: (id_, "Blue Door Cafe", lat, 90.0, rank)
    schema = "id string, name string, latitude double, longitude double, rank long"
    got = lambda rows: {r.id: r.leader_id for r in matching.cluster_duplicates(spark.createDataFrame(rows, schema)).collect()}
    a, b, c = 23.0, 23.0010, 23.0020  # a and c are about 222 m apart, b is between them
    assert got([place("A", a, 0), place("B", b, 1), place("C", c, 2)]) == {"A": "A", "B": "A", "C": "C"}
    assert got([place("B", b, 0), place("A", a, 1), place("C", c, 2)]) == {"B": "B", "A": "B", "C": "B"}
    assert got([("N", "??", a, 90.0, 0), ("M", "??", a, 90.0, 1)]) == {"N": "N", "M": "M"}
    assert got([]) == {}


def test_near_pairs_miss_nothing_at_high_latitudes(spark):
    import random

    r = random.Random(4)
    rows = [(i, "Blue Door", lat0 + r.uniform(-0.004, 0.004), 10 + r.uniform(-0.01, 0.01)) for lat0 in (-60.0, 0.0, 71.3) for i in range(0, 60)]
    rows = [(i, n, la, lo) for i, (_, n, la, lo) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, name string, latitude double, longitude double")
    got = {(x.id, x.r_id) for x in matching.near_pairs(df, df, 220.0, 0.5).collect()}
    d = df.alias("a").crossJoin(df.alias("b")).filter(numbers.haversine_m(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")) <= 220.0)
    assert got == {(x[0], x[1]) for x in d.select("a.id", "b.id").collect()} and len(got) > len(rows)
