"""Which seed rows belong to a run, and in what order they are taken."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words in a sub type that mark a place for drinks or baked goods.
CAFE_WORDS = ("cafe", "café", "coffee", "bakery", "tea", "dessert", "patisserie", "pastry")


@dataclass(frozen=True)
class Scope:
    areas: tuple[str, ...] = ("gulshan",)
    sub_areas: tuple[str, ...] = ("gulshan 1", "gulshan 2", "gulshan")
    excluded_sub_types: tuple[str, ...] = ("cyber",)
    require_cafe: bool = True


def contains_any(c: Column, words) -> Column:
    return F.coalesce(F.greatest(*[c.contains(w.lower()) for w in words], F.lit(False)), F.lit(False))


def scope_reason(scope: Scope = Scope(), sub_type: str = "sub_type", area: str = "area", sub_area: str = "sub_area") -> Column:
    """The first rule that a row fails, in words; NULL if it is in scope."""
    kind = F.lower(F.coalesce(F.col(sub_type), F.lit("")))
    shown = lambda c: F.coalesce(F.col(c), F.lit("None"))
    place = F.lower(F.concat(F.coalesce(F.col(sub_area), F.lit("")), F.lit(" "), F.coalesce(F.col(area), F.lit(""))))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for p in scope.excluded_sub_types:
        out = out.when(kind.contains(p.lower()), F.lit(f"sub_type matched exclusion pattern '{p}'"))
    if scope.require_cafe:
        out = out.when((kind != "") & ~contains_any(kind, CAFE_WORDS), F.concat(F.lit("sub_type '"), shown(sub_type), F.lit("' is not a cafe type")))
    out = out.when(~contains_any(place, scope.areas), F.concat(F.lit("area '"), shown(area), F.lit("/"), shown(sub_area), F.lit("' is outside scope")))
    allowed = ", ".join(scope.sub_areas)
    return out.when(~contains_any(place, scope.sub_areas), F.concat(F.lit("sub_area '"), shown(sub_area), F.lit(f"' is outside scope (allowed: {allowed})")))


def split_by_reason(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded with their ``reason``); every row is in exactly one."""
    tagged = df.withColumn("reason", reason)
    return tagged.filter("reason is null").drop("reason"), tagged.filter("reason is not null")


def named_area(sub_area: Column, area: Column) -> Column:
    """The reported area of a place: its numbered part, another part of the district, or NULL."""
    text = F.lower(F.concat(F.coalesce(sub_area, F.lit("")), F.lit(" "), F.coalesce(area, F.lit(""))))
    part = lambda n: contains_any(text, (f"gulshan {n}", f"gulshan-{n}", f"circle {n}"))
    return F.when(part(1), "Gulshan-1").when(part(2), "Gulshan-2").when(text.contains("gulshan"), "Other Gulshan")


def adaptive_filter(df: DataFrame, predicate: Column, at_least: int = 5) -> DataFrame:
    """Rows that satisfy the predicate if at least so many do, else all."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.filter((df.agg(F.count_if(hit)).scalar() < at_least) | hit)


def type_filter(df: DataFrame, type_col: str, types, keyword_text: Column, keywords: str, least: int = 3, share: float = 0.05) -> DataFrame:
    """Membership of the type list if max(least, share of all) rows are members; otherwise, or if that kept every row,
    the keyword pattern if at least ``least`` rows match it."""
    member = F.coalesce(F.lower(F.trim(F.col(type_col))).isin(*types), F.lit(False))
    word = F.coalesce(F.lower(keyword_text).rlike(keywords), F.lit(False))
    tagged = df.withColumn("_m", member).withColumn("_w", word)
    n = tagged.agg(F.count("*").alias("_n"), F.count_if("_m").alias("_nm"), F.count_if("_w").alias("_nw"))
    j = tagged.join(F.broadcast(n))
    by_type = (F.col("_nm") >= F.greatest(F.lit(float(least)), F.col("_n") * share)) & (F.col("_nm") < F.col("_n"))
    return j.filter(F.when(by_type, F.col("_m")).otherwise((F.col("_nw") < least) | F.col("_w"))).drop("_m", "_w", "_n", "_nm", "_nw")


def popularity_keys(popularity: str = "popularity", position: str = "pos") -> list[Column]:
    """Sort keys: ascending, NULL last, ties in file order."""
    return [F.col(popularity).asc_nulls_last(), F.col(position)]


def rank_or_score(df: DataFrame, popularity: str = "popularity") -> DataFrame:
    """Adds ``sort_key``: ascending if the column looks like a rank (least at most 2, whole numbers, largest at least half
    the count), else descending; NULL last when sorted with asc_nulls_last."""
    p = F.col(popularity)
    facts = df.agg(F.min(p).alias("_lo"), F.max(p).alias("_hi"), F.count(p).alias("_n"), F.coalesce(F.bool_and(p % 1 == 0), F.lit(False)).alias("_whole"))
    rank = (F.col("_lo") <= 2) & F.col("_whole") & (F.col("_hi") >= F.col("_n") * 0.5)
    return df.join(F.broadcast(facts)).withColumn("sort_key", F.when(rank, p).otherwise(-p)).drop("_lo", "_hi", "_n", "_whole")


def popularity_or_file_order(df: DataFrame, popularity: str = "popularity") -> DataFrame:
    """Adds ``sort_key``: the popularity if any is not 0, else NULL for all (file order)."""
    total = df.agg(F.coalesce(F.sum(F.abs(popularity)), F.lit(0.0)).alias("_total"))
    return df.join(F.broadcast(total)).withColumn("sort_key", F.when(F.col("_total") > 0, F.col(popularity))).drop("_total")


def nulls_last(*columns: str) -> Column:
    """A key that orders rows by columns, ascending, nulls last."""
    return F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))])


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the first by the columns ``order`` (ascending, nulls last; the last one unique). One
    aggregation, so rows of a frequent key are combined where they are."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(whole, nulls_last(*order)).alias("_row")).select("_row.*")


def dominant(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-null value, the smallest of several: (value, n)."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(1)
