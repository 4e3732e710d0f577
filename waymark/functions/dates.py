"""Run stamps and relative times. 'Now' is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import matched

RELATIVE = r"(?i)\b(?:a|an|(\d+))\s+(second|minute|hour|day|week|month|year)s?\s+ago\b"
# Seconds of a unit; a month has 30 days, a year 365.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400, "month": 30 * 86400, "year": 365 * 86400}


def relative_time(c: Column, anchor: Column) -> Column:
    """struct(raw, day): the trimmed text, and the date it names counted back from ``anchor``; NULL date if unreadable."""
    count = F.coalesce(matched(c, RELATIVE, 1).try_cast("long"), F.lit(1))
    seconds = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in pair])[F.lower(matched(c, RELATIVE, 2))]
    day = F.when(c.rlike(RELATIVE), (anchor - F.make_dt_interval(secs=count * seconds)).cast("date"))
    return F.struct(F.nullif(F.trim(c), F.lit("")).alias("raw"), day.alias("day"))


def run_stamp(path: Column) -> Column:
    """Time in a run folder's name, run_YYYYmmdd_HHMMSS, without zone; NULL if there is none."""
    return F.try_to_timestamp(matched(path, r"run_(\d{8}_\d{6})(?:/|$)"), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def iso_utc(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
