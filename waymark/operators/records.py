"""Records: from the seed, refreshed by payloads, identified, listed and summarised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions.values import is_empty_collection, truthy_number, truthy_text, union_distinct
from waymark.runtime import frozen

from .scope import named_area

PLATFORM, TAG = "GOOGLE_MAPS", "M-1"
TEXT_FIELDS = ("address", "phone", "website", "cuisine", "price_level", "menu_url", "google_maps_url", "plus_code")
# Statuses that a later run tries again.
RETRYABLE = ("blocked_or_error", "not_found", "geo_mismatch", "no_match", "legacy", "pending")


def from_seed(seed: DataFrame) -> DataFrame:
    """A pending record of each seed row."""
    return seed.select(
        "place_code",
        F.col("business_name").alias("name"),
        named_area(F.col("sub_area"), F.col("area")).alias("area"),
        F.col("address").alias("seed_address"),
        F.lit("UNKNOWN").alias("business_status"),
        F.lit("pending").alias("scrape_status"),
        F.lit(0).cast("long").alias("attempts"),
    )


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, ... over the whole table in ``order``, which must be unique.

    Rows are range-partitioned and counted within their partition; a window over partition totals, of which there are as many
    as partitions, gives the offset. No task sees more than its range.
    """
    parts = frozen(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    within = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return within.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_i")).drop("_part", "_i", "_before")


def merged_rows(rows: DataFrame, payloads: DataFrame, texts: list[str], lists: list[str], key: str = "place_code") -> DataFrame:
    """Rows with the payload of their key laid over them: a failed attempt (status other than ok) or none leaves a row
    untouched; else texts that are not empty replace, and lists grow by what is new, old entries first."""
    given = payloads.select(key, (F.col("status") == "ok").alias("_ok"), *[F.col(c).alias(f"_{c}") for c in (*texts, *lists)])
    joined = rows.join(given, key, "left")
    ok = F.coalesce("_ok", F.lit(False))
    new = {c: F.coalesce(F.when(ok, truthy_text(F.col(f"_{c}"))), F.col(c)) for c in texts} | {c: union_distinct(F.col(c), F.when(ok, F.col(f"_{c}"))) for c in lists}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns])


def assign_ids(rows: DataFrame, known: DataFrame, prefix: str = "GUL") -> DataFrame:
    """(place_code, cafe_id) of all rows: known ids stay, others follow the largest number in order of ``pos``."""
    new = rows.join(known.select("place_code"), "place_code", "left_anti").select("place_code", "pos")
    largest = known.agg(F.coalesce(F.max(F.regexp_extract("cafe_id", r"-(\d+)$", 1).try_cast("long")), F.lit(0)))
    number = F.col("n") + largest.scalar()
    text = F.when(number < 1000, F.lpad(number.cast("string"), 3, "0")).otherwise(number.cast("string"))
    made = numbered(new, [F.col("pos"), F.col("place_code")], "n").select("place_code", F.concat(F.lit(f"{prefix}-"), text).alias("cafe_id"))
    return known.select("place_code", "cafe_id").union(made)


def tagged(value: Column, as_of: Column) -> Column:
    """A platform's rating entry."""
    return F.array(F.struct(F.lit(PLATFORM).alias("platform"), F.lit(TAG).alias("source_tag"), value.alias("value"), F.lit(5).alias("scale"), as_of.alias("as_of")))


def socials(old_fb: Column, old_ig: Column, new_fb: Column, new_ig: Column) -> Column:
    """Social entries in fixed order, the new URL first choice."""
    entry = lambda p, n, o: F.when(F.coalesce(truthy_text(n), o).isNotNull(), F.struct(F.lit(p).alias("platform"), F.coalesce(truthy_text(n), o).alias("url")))
    return F.filter(F.array(entry("FACEBOOK", new_fb, old_fb), entry("INSTAGRAM", new_ig, old_ig)), lambda x: x.isNotNull())


def refresh(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """Records with payloads folded in, by place_code.

    Confidence, status and last attempt always change; fields only for status ok or legacy, and only where the payload has
    something (0 and '' are nothing, lists are replaced whole). ``payloads``: place_code, confidence, status, fetched_at
    and the record's fields; rows without a record are left out.
    """
    p = payloads.select("place_code", F.struct(*[c for c in payloads.columns if c != "place_code"]).alias("p"))
    j = records.join(p, "place_code", "left")
    seen = F.col("p").isNotNull()
    use = F.coalesce(F.col("p.status").isin("ok", "legacy"), F.lit(False))
    kinds = {f.name: f.dataType.typeName() for f in records.schema.fields}
    out = []
    for c in records.columns:
        old, new = F.col(c), F.col(f"p.{c}") if c in payloads.columns else None
        if c == "place_code":
            out.append(old)
        elif c in ("match_confidence", "scrape_status", "last_attempt"):
            source = {"match_confidence": "p.confidence", "scrape_status": "p.status", "last_attempt": "p.fetched_at"}[c]
            out.append(F.when(seen, F.col(source)).otherwise(old).alias(c))
        elif c == "last_updated":
            out.append(F.when(use, F.col("p.fetched_at")).otherwise(old).alias(c))
        elif c == "attempts":
            out.append((old + seen.cast("long")).alias(c))
        elif new is None:
            out.append(old)
        else:
            kind = kinds[c]
            something = F.when(~is_empty_collection(new), new) if kind in ("array", "map") else truthy_text(new) if kind == "string" else truthy_number(new)
            out.append(F.coalesce(F.when(use, something), old).alias(c))
    return j.select(*out)


def gaps(menu: Column, priced: Column, rating: Column, reviews: Column, count: Column, hours: Column, status: Column) -> Column:
    """Missing priority fields, in order; each argument but the status says whether the field is there."""
    names = (("menu", menu), ("price", priced), ("rating", rating), ("reviews", reviews), ("review_count", count), ("hours", hours))
    listed = [F.when(~F.coalesce(there, F.lit(False)), F.lit(n)) for n, there in names]
    return F.filter(F.array(*listed, F.when(status == "pending", F.lit("not_scraped"))), lambda x: x.isNotNull())


def excluded_reason(scrape_status: Column, business_status: Column, duplicate_of: Column) -> Column:
    return (
        F.when(scrape_status == "out_of_scope", "outside the configured scope")
        .when(business_status == "PERMANENTLY_CLOSED", "permanently closed")
        .when(F.coalesce(duplicate_of, F.lit("")) != "", F.concat(F.lit("duplicate listing of "), duplicate_of))
    )


def summary(records: DataFrame) -> DataFrame:
    """One row of counts over records with excluded_reason, missing (array), business_status, duplicate_of."""
    live = F.col("excluded_reason").isNull()
    lacks = lambda f: F.count_if(live & F.array_contains("missing", f))
    has = lambda f: F.count_if(live & ~F.array_contains("missing", f))
    return records.agg(
        F.count("*").alias("records_total"),
        F.count_if(live).alias("live"),
        F.count_if(~live).alias("excluded"),
        F.count_if(F.col("business_status") == "PERMANENTLY_CLOSED").alias("permanently_closed"),
        F.count_if(F.coalesce(F.col("duplicate_of"), F.lit("")) != "").alias("duplicates"),
        *[lacks(f).alias(f"missing_{f}") for f in ("menu", "price", "rating", "reviews", "review_count", "hours")],
        lacks("not_scraped").alias("not_scraped_yet"),
        *[has(f).alias(f"with_{f}") for f in ("rating", "hours", "reviews")],
    )


def pending(leaders: DataFrame, store: DataFrame, max_attempts: int = 3, limit: int | None = None, position: str = "pos") -> DataFrame:
    """Leaders that a run still has to take. ``store``: place_code, scrape_status, attempts, complete (boolean)."""
    s = store.select("place_code", "scrape_status", "attempts", "complete", F.lit(True).alias("_known"))
    spent = F.col("attempts") >= max_attempts
    done = F.when(F.col("scrape_status") == "ok", F.col("complete") | spent).otherwise(~F.col("scrape_status").isin(*RETRYABLE) | spent)
    out = leaders.join(s, "place_code", "left").filter(F.col("_known").isNull() | ~done).select(*leaders.columns)
    return out.orderBy(position).limit(limit) if limit else out


def upsert(store: DataFrame, rows: DataFrame, key: str = "place_code") -> DataFrame:
    """``rows`` replace those of the store with the same key; columns by name."""
    return store.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def batches(df: DataFrame, size: int, order: list[Column]) -> DataFrame:
    """Adds ``batch``: chunks of ``size`` rows in ``order``, which must be unique."""
    return numbered(df, order, "_place").withColumn("batch", F.floor((F.col("_place") - 1) / size).cast("long")).drop("_place")
