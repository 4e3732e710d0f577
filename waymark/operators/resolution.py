"""Observations of several sources: merged per source, resolved by priority with provenance, scored.

An observation is (place_code, src, field values ..., fetched_at, status). Resolution is one aggregation per place: for
each field the first source in its order that has a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.numbers import round_even
from waymark.functions.values import is_empty, joined_sorted

# The order of sources for each field, and the weights of fields.
PRIORITY = {
    "address": ("g", "fp", "osm", "seed"),
    "latitude": ("g", "osm", "seed"),
    "longitude": ("g", "osm", "seed"),
    "phone": ("g", "fp", "osm", "web"),
    "website": ("g", "osm", "web"),
    "opening_hours": ("g", "fp", "osm"),
    "rating": ("g", "fp", "ta"),
    "review_count": ("g", "fp", "ta"),
    "review_snippets": ("g", "ta"),
    "menu_items": ("fp", "g"),
    "price_range": ("g", "fp", "ta"),
    "facebook_url": ("web", "g", "osm"),
    "instagram_url": ("web", "g", "osm"),
    "business_status": ("g", "osm", "fp"),
    "osm_id": ("osm",),
    "category": ("g", "osm"),
}
CORE = ("business_name", "latitude", "longitude", "address", "phone", "opening_hours")
RICH = ("rating", "review_count", "review_snippets", "website")
BONUS = ("menu_items", "facebook_url", "instagram_url", "foodpanda_url", "tripadvisor_url", "price_range", "osm_id")
WEIGHTS = {**dict.fromkeys(CORE, 3), **dict.fromkeys(RICH, 2), **dict.fromkeys(BONUS, 1)}
LEAST_RICH, LEAST_DAYS = 3, 5
RICHNESS = ("rating", "review_count", "reviews", "hours", "address", "phone", "website", "facebook_url", "instagram_url", "category", "price_level")
SCRAPED = ("g", "fp", "ta")


def latest_per_source(observations: DataFrame, fields: list[str], time: list[str]) -> DataFrame:
    """One block per (place_code, src): status and time of the last observation, whatever came of it, and each field's
    last value that is not empty, so a failed visit never erases data. ``time``: columns that order visits uniquely."""
    order = F.struct(*time)
    kinds = dict(observations.dtypes)
    full = lambda f: ~is_empty(F.col(f), ()) if kinds[f] == "string" else F.size(f) > 0 if kinds[f].startswith(("array", "map")) else F.col(f).isNotNull()
    return observations.groupBy("place_code", "src").agg(
        F.max_by("status", order).alias("status"),
        F.max(time[0]).alias(time[0]),
        *[F.max_by(F.when(full(f), F.col(f)), F.when(full(f), order)).alias(f) for f in fields],
    )


def usable(field: str, kind: str) -> Column:
    """Whether a source's value may resolve the field: not empty, five days of hours, a known status."""
    c = F.col(field)
    if field == "opening_hours" and kind.startswith("map"):
        return F.size(c) >= LEAST_DAYS
    if field == "business_status":
        return ~is_empty(c, ("UNKNOWN",))
    if kind == "string":
        return ~is_empty(c, ())
    return F.size(c) > 0 if kind.startswith(("array", "map")) else c.isNotNull()


def source_statuses() -> Column:
    """Aggregate: map of source to status over a place's blocks (one per source, so its size is bounded)."""
    return F.map_from_entries(F.collect_list(F.struct("src", "status")))


def resolve(blocks: DataFrame, fields: list[str], previous: DataFrame | None = None, *more: Column) -> DataFrame:
    """(place_code, fields, <field>_source): the first usable source in the field's order. With ``previous`` (the same
    columns) a field that no source has now keeps what it had. ``more``: further aggregates of the same pass (without
    ``previous``)."""
    kinds = dict(blocks.dtypes)
    columns = []
    for f in fields:
        order = F.create_map(*[F.lit(x) for i, s in enumerate(PRIORITY[f]) for x in (s, i)])
        place = F.when(usable(f, kinds[f]), F.try_element_at(order, F.col("src")))
        columns += [F.min_by(F.when(place.isNotNull(), F.col(f)), place).alias(f), F.min_by("src", place).alias(f"{f}_source")]
    now = blocks.groupBy("place_code").agg(*columns, *more)
    if previous is None:
        return now
    kept = previous.select("place_code", *[F.col(f"{f}{s}").alias(f"_{f}{s}") for f in fields for s in ("", "_source")])
    joined = now.join(kept, "place_code", "full_outer")
    pick = [x for f in fields for x in (F.coalesce(f, f"_{f}").alias(f), F.when(F.col(f).isNotNull(), F.col(f"{f}_source")).otherwise(F.col(f"_{f}_source")).alias(f"{f}_source"))]
    return joined.select("place_code", *pick)


def accumulate(items: DataFrame, field: str, key: Column) -> DataFrame:
    """Distinct items of a list field over all sources: (place_code, src, item, place), first kept in the order of sources
    and positions. ``items``: place_code, src, pos, item. The first of equal items is found by an aggregation; what is
    left of one place, a list that is one record's, is numbered as an array."""
    order = F.create_map(*[F.lit(x) for i, s in enumerate(PRIORITY[field]) for x in (s, i)])
    ranked = items.withColumn("_o", F.try_element_at(order, F.col("src"))).filter("_o is not null").withColumn("_key", key)
    entry = F.struct("_o", "pos", "src", "item")
    first = ranked.groupBy("place_code", "_key").agg(F.min_by(entry, F.struct("_o", "pos")).alias("e"))
    listed = first.groupBy("place_code").agg(F.array_sort(F.collect_list("e"), lambda a, b: F.when((a["_o"] < b["_o"]) | ((a["_o"] == b["_o"]) & (a["pos"] < b["pos"])), -1).otherwise(1)).alias("es"))
    return listed.select("place_code", F.posexplode("es").alias("place", "e")).select("place_code", "e.src", "e.item", (F.col("place") + 1).alias("place"))


def provenance(items: DataFrame) -> DataFrame:
    """(place_code, provenance): the sources of a list field, joined by +."""
    return items.groupBy("place_code").agg(joined_sorted(F.collect_set("src")).alias("provenance"))


def derived_web(blocks: DataFrame, source: str = "g") -> DataFrame:
    """A block of the web source for every place whose ``source`` names a website."""
    return blocks.filter((F.col("src") == source) & ~is_empty(F.col("website"), ())).select("place_code", "website", F.lit("web").alias("src"), F.lit("derived").alias("status"))


def inferred_status(resolved: Column, ok_sources: Column) -> Column:
    """struct(status, source): the resolved status, else operational if any scraped source is ok, else unknown."""
    guess = F.when(F.coalesce(ok_sources, F.lit(0)) > 0, "OPERATIONAL").otherwise("UNKNOWN")
    return F.struct(F.coalesce(resolved, guess).alias("status"), F.when(resolved.isNull(), "inferred").alias("source"))


def completeness(present: dict[str, Column], weights: dict[str, int] | None = None) -> Column:
    """Share of the weights of present fields, four decimals, half to even."""
    weights = weights or WEIGHTS
    got = sum((F.when(F.coalesce(c, F.lit(False)), weights[f]).otherwise(0) for f, c in present.items()), F.lit(0))
    return round_even(got / float(sum(weights.values())), 4)


def _count(present: dict[str, Column], fields) -> Column:
    return sum((F.coalesce(present[f], F.lit(False)).cast("int") for f in fields if f in present), F.lit(0))


def accepted(present: dict[str, Column], status: Column, core=CORE, rich=RICH, closed_ok: bool = True) -> Column:
    """All core fields and enough rich ones; a closed venue needs only its address and place."""
    full = (_count(present, core) == len(core)) & (_count(present, rich) >= LEAST_RICH)
    if not closed_ok:
        return full
    shut = F.coalesce(status.isin("PERMANENTLY_CLOSED", "TEMPORARILY_CLOSED", "Permanently Closed", "Temporarily Closed"), F.lit(False))
    return F.when(shut, _count(present, ("address", "latitude")) == 2).otherwise(full)


def missing_report(present: dict[str, Column], core=CORE, rich=RICH) -> Column:
    """core:<field> for each missing one, and rich:<n>/<least> if too few are there."""
    n = _count(present, rich)
    listed = [F.when(~F.coalesce(present[f], F.lit(False)), F.lit(f"core:{f}")) for f in core]
    return F.filter(F.array(*listed, F.when(n < LEAST_RICH, F.concat(F.lit("rich:"), n.cast("string"), F.lit(f"/{LEAST_RICH}")))), lambda x: x.isNotNull())


def record_status(is_accepted: Column, statuses: Column) -> Column:
    """accepted, not_found (g and fp both name no place), partial_blocked or partial, from a map of source statuses."""
    lost = lambda s: F.coalesce(F.try_element_at(statuses, F.lit(s)).isin("not_found", "geo_mismatch", "name_mismatch"), F.lit(False))
    blocked = F.exists(F.map_values(statuses), lambda v: v == "blocked_or_error")
    return F.when(is_accepted, "accepted").when(lost("g") & lost("fp"), "not_found").when(blocked, "partial_blocked").otherwise("partial")


def richness(df: DataFrame) -> Column:
    """How many of the eleven fields a payload has; '' and 0 count, empty lists and maps do not."""
    kinds = dict(df.dtypes)
    there = lambda c: (F.size(c) > 0) if kinds[c].startswith(("array", "map")) else F.col(c).isNotNull()
    return sum((F.coalesce(there(c), F.lit(False)).cast("int") for c in RICHNESS if c in kinds), F.lit(0))


def best_payload(payloads: DataFrame, score: str, order: list[str], key: str = "place_code") -> DataFrame:
    """The richest payload of each key; of several the last by the columns ``order`` (unique). One aggregation."""
    whole = F.struct(*[F.col(c) for c in payloads.columns])
    return payloads.groupBy(F.col(key).alias("_key")).agg(F.max_by(whole, F.struct(score, *order)).alias("_row")).select("_row.*")


def flattened(blocks: DataFrame, fields: list[str], sources: tuple[str, ...]) -> DataFrame:
    """One row per place with <src>_<field> side by side."""
    return blocks.groupBy("place_code").agg(*[F.max(F.when(F.col("src") == s, F.col(f))).alias(f"{s}_{f}") for s in sources for f in fields])
