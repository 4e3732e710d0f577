"""Hours are computed once for a row and day: what is read at several places is not written out at each."""

import pytest
from pyspark.sql import functions as F

from waymark.functions import hours, values
from waymark.plans import base, pages


def written(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([("Monday 9 AM–10 PM",)], "t string")


def test_a_bound_value_is_written_once(texts):
    plan = written(texts.select(values.once(F.regexp_replace("t", "x+", ""), lambda t: F.concat(t, t, t)).alias("x")))
    assert plan.count("regexp_replace") == 1


def test_h06_hours_in_text(texts):
    plan = written(texts.select(F.to_json(hours.hours_in_text(F.col("t"))).alias("x")))
    assert plan.count("Friday|Saturday") == 2
    assert plan.count("24hrs") == 1


def test_a_span_is_matched_once(texts):
    assert written(texts.select(hours.parse_span(F.col("t")).alias("x"))).count(hours.SPAN) == 1


def test_h14_enough_days(texts):
    assert written(texts.select(hours.enough_days(hours.hours_in_text(F.col("t"))).alias("x"))).count("24hrs") == 1


def test_h15_rows_are_dealt_over_the_cores(spark, sf_dir):
    df = base.CATALOGUE["H15_day_rows"][0](spark, sf_dir)
    assert df.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert written(df).count("24hrs") == 1


def test_m16_legacy_payload(spark, sf_dir):
    assert written(pages.legacy(pages.profiles(spark, sf_dir))).count("24hrs") == 1


def test_a04_legacy_richness(spark, sf_dir):
    df = pages.legacy_richness(spark, sf_dir)
    assert df.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert written(df).count("24hrs") == 1


@pytest.mark.parametrize(
    ("raw", "span"),
    [
        ("9-10", "09:00-10:00"), (" 9:05 AM - 10 pm ", "09:05-22:00"), ("12-1 AM", "00:00-01:00"), ("12–1 PM", "12:00-13:00"), ("24:00-24:59", "24:00-24:59"), ("25-26", None), ("9:60-10", None),
        ("0-0", None), ("12 AM-12 AM", None), ("1,2,3,4,5,6", None), ("9,,am,10,,pm", None), ("9-10-11", None), ("9", None), ("", None), (None, None),
    ],
)
def test_spans(spark, raw, span):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(hours.parse_span(F.col("t"))).first()[0] == span
