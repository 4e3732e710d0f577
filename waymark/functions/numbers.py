"""Numbers out of displayed text, distances and rounding, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
# Formats of counts, ratings and prices.
COUNT = r"([\d][\d,\s.]*\d|\d)\s*([kKmM])?"
COUNT_WORD = r"([\d][\d,\s.]*\d|\d)\s*([kKmM](?![A-Za-z]))?"
PLAIN_COUNT = r"([\d][\d,\s]{0,9}\d|\d)"
RATING = r"\b([0-5](?:\.\d)?)\b"
PRICE_BDT = r"(?i)(?:৳|BDT|Tk\.?)\s*([\d,]+(?:\.\d{1,2})?)"
RATING_COUNT = r"([0-5]\.\d)\s*\(?\s*([\d,.]+\s*[kKmM]?)"


def matched(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, NULL where there is none (regexp_extract gives '')."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def number(c: Column) -> Column:
    """to_float: commas dropped; NULL unless it is a finite decimal number."""
    t = F.regexp_replace(F.trim(c), ",", "")
    return F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), finite(t.try_cast("double")))


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def _spaces(c: Column) -> Column:
    return F.replace(c, F.lit("\u00a0"), F.lit(" "))


def parse_count(c: Column, word_suffix: bool = False) -> Column:
    """struct(value, approximate): '1,234' is 1234, '1.2K' is 1200 and approximate. ``word_suffix`` accepts k and m only
    where no letter follows ('4 min' is 4 then; by default its m counts as a million)."""
    pattern = COUNT_WORD if word_suffix else COUNT
    text = _spaces(c)
    digits = F.regexp_replace(matched(text, pattern), "[, ]", "")
    suffix = F.lower(matched(text, pattern, 2))
    value = F.when(digits.rlike(r"^[0-9]+\.?[0-9]*$"), digits.try_cast("double"))
    scaled = value * F.when(suffix == "k", 1_000.0).when(suffix == "m", 1_000_000.0).otherwise(1.0)
    known = value.isNotNull()
    return F.struct(F.when(known, scaled).cast("long").alias("value"), F.coalesce(known & suffix.isNotNull(), F.lit(False)).alias("approximate"))


def parse_plain_count(c: Column) -> Column:
    """to_int: digits with commas and blanks; neither a suffix nor a decimal part is read ('1.2K' is 1)."""
    return F.regexp_replace(matched(_spaces(c), PLAIN_COUNT), r"[,\s]", "").try_cast("long")


def parse_rating(c: Column) -> Column:
    """First free-standing 0..5 with at most one decimal; NULL for 0."""
    value = matched(F.replace(c, F.lit(","), F.lit(".")), RATING).try_cast("double")
    return F.when((value > 0) & (value <= 5), value)


def rating_and_count(c: Column) -> Column:
    """struct(rating, count, approximate) from body text like '4.5 (1,234)'."""
    count = parse_count(matched(c, RATING_COUNT, 2))
    return F.struct(parse_rating(matched(c, RATING_COUNT, 1)).alias("rating"), count["value"].alias("count"), count["approximate"].alias("approximate"))


def price_bdt(c: Column) -> Column:
    return number(matched(c, PRICE_BDT))


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle metres."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lng1, lng2)
    return F.lit(2 * EARTH_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def round_even(c: Column, digits: int = 0) -> Column:
    """Half to even, as displayed figures are rounded."""
    return F.bround(c, digits)
