"""Queries of records, source blocks, resolution, scores and work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import records, resolution
from waymark.sources import registry

from .base import OBSERVATIONS, SEED, Input, query
from .places import AREA_SQL, WITH_SEED

FIELDS = ["rating", "review_count", "address", "phone", "website", "business_status", "latitude"]
# One block per place and source: the last status, and each field's last value that is not empty.
_LAST = ", ".join(f"arg_max({f}, (ts, event_id)) FILTER ({f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '') AS {f}" for f in FIELDS)
BLOCKS_SQL = f"SELECT place_code, src, arg_max(status, (ts, event_id)) AS status, max(ts) AS ts, {_LAST} FROM ({OBSERVATIONS.sql}) GROUP BY 1, 2"


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = registry.observations([registry.Source("visits", OBSERVATIONS.frame)], spark, sf_dir)
    return resolution.latest_per_source(seen, FIELDS, ["ts", "event_id"])


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")) if "ts" in df.columns else df


@query("M06_source_blocks", f"SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts) FROM ({BLOCKS_SQL})")
def source_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(blocks(spark, sf_dir))


def _resolved_sql() -> str:
    parts = []
    for f in FIELDS:
        wheres = {"business_status": f"coalesce({f}, '') NOT IN ('', 'UNKNOWN')"}.get(f, f"{f} IS NOT NULL AND CAST({f} AS VARCHAR) <> ''")
        pick = lambda what, f=f, w=wheres: "coalesce(" + ", ".join(f"max({what}) FILTER (src = '{s}' AND {w})" for s in resolution.PRIORITY[f]) + ")"
        parts += [f"{pick(f)} AS {f}", f"{pick('src')} AS {f}_source"]
    return f"SELECT place_code, {', '.join(parts)} FROM b GROUP BY 1"


RESOLVED_SQL = f"WITH b AS ({BLOCKS_SQL}) {_resolved_sql()}"


@query("M07_resolve", RESOLVED_SQL)
def resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.resolve(blocks(spark, sf_dir), FIELDS)


@query(
    "M07_resolve_sticky",
    f"WITH now AS ({RESOLVED_SQL}), old AS (SELECT place_code, 9.5::DOUBLE AS rating, 'ta' AS rating_source FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS place_code FROM events) UNION ALL SELECT 'gone', 1.5, 'g') "
    "SELECT coalesce(now.place_code, old.place_code) AS place_code, coalesce(now.rating, old.rating) AS rating, CASE WHEN now.rating IS NULL THEN old.rating_source ELSE now.rating_source END AS rating_source FROM now FULL JOIN old ON now.place_code = old.place_code",
)
def resolve_sticky(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir)
    old = b.select("place_code").distinct().select("place_code", F.lit(9.5).alias("rating"), F.lit("ta").alias("rating_source"))
    old = old.union(spark.createDataFrame([("gone", 1.5, "g")], old.schema))
    return resolution.resolve(b, ["rating"], old)


ITEMS = Input({"place_code": "CAST(user_id AS STRING)", "src": "CASE event_type WHEN 'view' THEN 'g' WHEN 'click' THEN 'ta' WHEN 'purchase' THEN 'fp' ELSE 'osm' END", "pos": "event_id", "item": "concat('text ', CAST(event_id % 40 AS STRING))"}, "events")
ITEMS_SQL = f"SELECT place_code, src, item, row_number() OVER (PARTITION BY place_code ORDER BY o, pos) AS place FROM (SELECT *, row_number() OVER (PARTITION BY place_code, item ORDER BY o, pos) AS rn FROM (SELECT *, CASE src WHEN 'g' THEN 0 WHEN 'ta' THEN 1 END AS o FROM ({ITEMS.sql})) WHERE o IS NOT NULL) WHERE rn = 1"


@query("M08_accumulate", ITEMS_SQL)
def accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.accumulate(ITEMS.frame(spark, sf_dir), "review_snippets", F.col("item")).withColumn("place", F.col("place").cast("long"))


@query("M08_provenance", f"SELECT place_code, string_agg(DISTINCT src, '+' ORDER BY src) AS provenance FROM ({ITEMS_SQL}) GROUP BY 1")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.provenance(resolution.accumulate(ITEMS.frame(spark, sf_dir), "review_snippets", F.col("item")))


@query(
    "M09_inferred_status",
    f"WITH b AS ({BLOCKS_SQL}), r AS ({_resolved_sql()}), ok AS (SELECT place_code, count(*) FILTER (status = 'ok' AND src IN ('g', 'fp', 'ta')) AS n FROM b GROUP BY 1) "
    "SELECT place_code, coalesce(business_status, CASE WHEN n > 0 THEN 'OPERATIONAL' ELSE 'UNKNOWN' END) AS status, CASE WHEN business_status IS NULL THEN 'inferred' END AS inferred FROM r JOIN ok USING (place_code)",
)
def inferred_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.count_if((F.col("status") == "ok") & F.col("src").isin(*resolution.SCRAPED)).alias("n")
    r = resolution.resolve(blocks(spark, sf_dir), ["business_status"], None, ok).withColumn("s", resolution.inferred_status(F.col("business_status"), F.col("n")))
    return r.select("place_code", "s.status", F.col("s.source").alias("inferred"))


@query("M10_derived_web", f"SELECT place_code, website, 'web' AS src, 'derived' AS status FROM ({BLOCKS_SQL}) WHERE src = 'g' AND website IS NOT NULL")
def derived_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.derived_web(blocks(spark, sf_dir))


# Scores ----------------------------------------------------------------------------------------------------------
def present(df: DataFrame) -> dict:
    there = {f: F.col(f).isNotNull() for f in FIELDS if f in resolution.WEIGHTS}
    there |= {"business_name": F.lit(True), "longitude": there["latitude"]}
    return {f: there.get(f, F.lit(False)) for f in resolution.WEIGHTS} | {"opening_hours": F.col("rating") > 3, "review_snippets": F.col("review_count") > 400}


PRESENT_SQL = {f: "FALSE" for f in resolution.WEIGHTS} | {f: f"{f} IS NOT NULL" for f in FIELDS if f in resolution.WEIGHTS}
PRESENT_SQL |= {"business_name": "TRUE", "longitude": "latitude IS NOT NULL", "opening_hours": "coalesce(rating > 3, FALSE)", "review_snippets": "coalesce(review_count > 400, FALSE)"}
_GOT = " + ".join(f"CASE WHEN {PRESENT_SQL[f]} THEN {3 if f in resolution.CORE else 2 if f in resolution.RICH else 1} ELSE 0 END" for f in resolution.WEIGHTS)
_NCORE = " + ".join(f"CAST({PRESENT_SQL[f]} AS INT)" for f in resolution.CORE)
_NRICH = " + ".join(f"CAST({PRESENT_SQL[f]} AS INT)" for f in resolution.RICH)
ACCEPTED_SQL = f"CASE WHEN business_status = 'PERMANENTLY_CLOSED' THEN address IS NOT NULL AND latitude IS NOT NULL ELSE ({_NCORE}) = 6 AND ({_NRICH}) >= 3 END"


@query("A02_completeness", f"WITH r AS ({RESOLVED_SQL}) SELECT place_code, round_even(({_GOT}) / 33.0, 4) AS completeness FROM r")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = resolve(spark, sf_dir)
    return r.select("place_code", resolution.completeness(present(r)).alias("completeness"))


@query("A03_accepted", f"WITH r AS ({RESOLVED_SQL}) SELECT place_code, {ACCEPTED_SQL} AS accepted, ({_NCORE}) = 6 AND ({_NRICH}) >= 3 AS accepted_open FROM r")
def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = resolve(spark, sf_dir)
    p = present(r)
    return r.select("place_code", resolution.accepted(p, F.col("business_status")).alias("accepted"), resolution.accepted(p, F.col("business_status"), closed_ok=False).alias("accepted_open"))


@query(
    "M22_missing_report",
    f"WITH r AS ({RESOLVED_SQL}) SELECT place_code, concat_ws(',', " + ", ".join(f"CASE WHEN NOT {PRESENT_SQL[f]} THEN 'core:{f}' END" for f in resolution.CORE) + f", CASE WHEN ({_NRICH}) < 3 THEN 'rich:' || ({_NRICH}) || '/3' END) AS missing FROM r",
)
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = resolve(spark, sf_dir)
    return r.select("place_code", F.array_join(resolution.missing_report(present(r)), ",").alias("missing"))


STATUS_SQL = (
    f"WITH b AS ({BLOCKS_SQL}), r AS ({_resolved_sql()}), s AS (SELECT place_code, max(status) FILTER (src = 'g') AS g, max(status) FILTER (src = 'fp') AS fp, bool_or(status = 'blocked_or_error') AS blocked FROM b GROUP BY 1) "
    f"SELECT r.place_code, CASE WHEN {ACCEPTED_SQL} THEN 'accepted' WHEN g IN ('not_found', 'geo_mismatch', 'name_mismatch') AND fp IN ('not_found', 'geo_mismatch', 'name_mismatch') THEN 'not_found' WHEN blocked THEN 'partial_blocked' ELSE 'partial' END AS status FROM r JOIN s USING (place_code)"
)


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = resolution.resolve(blocks(spark, sf_dir), FIELDS, None, resolution.source_statuses().alias("s"))
    ok = resolution.accepted(present(r), F.col("business_status"))
    return r.withColumn("accepted", ok).withColumn("status", resolution.record_status(F.col("accepted"), F.col("s"))).withColumn("completeness", resolution.completeness(present(r)))


@query("M12_record_status", STATUS_SQL)
def record_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).select("place_code", "status")


@query("M24_enrich", f"WITH x AS ({RESOLVED_SQL}), st AS ({STATUS_SQL}) SELECT x.place_code, address, address_source, round_even(({_GOT}) / 33.0, 4) AS completeness, status FROM x JOIN st USING (place_code)")
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From visits of all sources to resolved, scored and judged records in one plan."""
    return statuses(spark, sf_dir).select("place_code", "address", "address_source", "completeness", "status")


@query("O04_accepted_first", f"WITH x AS ({RESOLVED_SQL}) SELECT place_code, row_number() OVER (ORDER BY {ACCEPTED_SQL} DESC, round_even(({_GOT}) / 33.0, 4) DESC, place_code) AS place FROM x")
def accepted_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("accepted"), F.desc("completeness"), F.col("place_code")]
    return records.numbered(statuses(spark, sf_dir).select("place_code", "accepted", "completeness"), order, "place").select("place_code", "place")


@query("O09_until_target", f"WITH x AS ({RESOLVED_SQL}), s AS (SELECT place_code, {ACCEPTED_SQL} AS ok, round_even(({_GOT}) / 33.0, 4) AS c FROM x) SELECT place_code FROM (SELECT place_code, coalesce(sum(ok::INT) OVER (ORDER BY c DESC, place_code ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM s) WHERE done < 5")
def until_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in order of completeness until five are accepted. Only five accepted rows decide, found by a bounded top."""
    s = statuses(spark, sf_dir).select("place_code", "accepted", "completeness")
    order = F.struct((-F.col("completeness")).alias("c"), F.col("place_code").alias("p"))
    fifth = s.filter("accepted").select(order.alias("o")).orderBy("o").limit(5).agg(F.when(F.count("*") == 5, F.max("o")).alias("stop"))
    return s.join(F.broadcast(fifth)).filter(F.col("stop").isNull() | (order <= F.col("stop"))).select("place_code")


_RICH_SQL = "(rating IS NOT NULL)::INT + (review_count IS NOT NULL)::INT + (address IS NOT NULL)::INT + (phone IS NOT NULL)::INT + (website IS NOT NULL)::INT"


@query("A04_richness", f"SELECT event_id, CAST({_RICH_SQL} AS BIGINT) AS richness FROM ({OBSERVATIONS.sql})")
def richness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = OBSERVATIONS.frame(spark, sf_dir)
    return o.select("event_id", resolution.richness(o).cast("long").alias("richness"))


@query("A05_best_payload", f"SELECT place_code, event_id FROM (SELECT place_code, event_id, row_number() OVER (PARTITION BY place_code ORDER BY {_RICH_SQL} DESC, ts DESC, event_id DESC) AS rn FROM ({OBSERVATIONS.sql})) WHERE rn = 1")
def best_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = OBSERVATIONS.frame(spark, sf_dir)
    return resolution.best_payload(o.withColumn("score", resolution.richness(o)), "score", ["ts", "event_id"]).select("place_code", "event_id")


@query("A07_store_counts", f"WITH x AS ({RESOLVED_SQL}) SELECT count(*) AS total, count(*) FILTER ({ACCEPTED_SQL}) AS accepted, count(*) FILTER (business_status = 'TEMPORARILY_CLOSED') AS temporarily_closed, count(*) FILTER (business_status = 'PERMANENTLY_CLOSED') AS permanently_closed FROM x")
def store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = lambda s: F.count_if(F.col("business_status") == s)
    return statuses(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if("accepted").alias("accepted"), closed("TEMPORARILY_CLOSED").alias("temporarily_closed"), closed("PERMANENTLY_CLOSED").alias("permanently_closed"))


@query("A12_accepted_count", f"WITH x AS ({RESOLVED_SQL}) SELECT count(*) FILTER ({ACCEPTED_SQL}) AS accepted FROM x")
def accepted_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).agg(F.count_if("accepted").alias("accepted"))


@query("A08_tag_histogram", "SELECT coalesce(nullif(lang, 'de'), 'not_scraped') AS tag, count(*) AS n FROM documents GROUP BY 1")
def tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.coalesce(F.nullif(F.col("lang"), F.lit("de")), F.lit("not_scraped"))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy(tag.alias("tag")).agg(F.count("*").alias("n")).orderBy("tag")


# Records ---------------------------------------------------------------------------------------------------------
def seed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.from_seed(SEED.frame(spark, sf_dir))


@query("M01_from_seed", f"{WITH_SEED}, h AS (SELECT *, lower(coalesce(sub_area, '') || ' ' || coalesce(area, '')) AS h FROM seed) SELECT place_code, business_name AS name, {AREA_SQL} AS area, address AS seed_address, 'UNKNOWN' AS business_status, 'pending' AS scrape_status, 0::BIGINT AS attempts FROM h")
def from_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_records(spark, sf_dir)


PAYLOADS = Input(
    {
        "place_code": f"CAST({'c_custkey'} AS STRING)",
        "confidence": "CASE c_custkey % 3 WHEN 0 THEN 'high' ELSE 'low' END",
        "status": "CASE c_custkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'legacy' WHEN 2 THEN 'not_found' ELSE 'ok' END",
        "fetched_at": "concat('2024-01-', CAST(10 + c_custkey % 15 AS STRING), 'T00:00:00Z')",
        "address": "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('New ', CAST(c_custkey AS STRING)) END",
        "latitude": "CASE WHEN c_custkey % 7 = 0 THEN 0e0 ELSE c_custkey / 1e1 END",
    },
    "customer",
    where="c_custkey % 6 <> 0",
)
_OLD = {"place_code": "CAST(c_custkey AS STRING)", "match_confidence": "CAST(NULL AS STRING)", "scrape_status": "'pending'", "attempts": "c_custkey % 2", "last_attempt": "CAST(NULL AS STRING)", "last_updated": "CAST(NULL AS STRING)", "address": "concat('Old ', CAST(c_custkey AS STRING))", "latitude": "1.5e0"}
OLD = Input(_OLD, "customer")


@query(
    "M03_refresh",
    f"WITH o AS ({OLD.sql}), p AS ({PAYLOADS.sql}) SELECT o.place_code, p.confidence AS match_confidence, coalesce(p.status, o.scrape_status) AS scrape_status, o.attempts + (p.status IS NOT NULL)::BIGINT AS attempts, p.fetched_at AS last_attempt, "
    "CASE WHEN p.status IN ('ok', 'legacy') THEN p.fetched_at END AS last_updated, CASE WHEN p.status IN ('ok', 'legacy') AND p.address <> '' THEN p.address ELSE o.address END AS address, CASE WHEN p.status IN ('ok', 'legacy') AND p.latitude <> 0 THEN p.latitude ELSE o.latitude END AS latitude FROM o LEFT JOIN p USING (place_code)",
)
def refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.refresh(OLD.frame(spark, sf_dir), PAYLOADS.frame(spark, sf_dir))


@query("M04_tagged", f"SELECT place_code, '{{\"platform\":\"GOOGLE_MAPS\",\"source_tag\":\"M-1\",\"value\":' || latitude || ',\"scale\":5,\"as_of\":\"' || fetched_at || '\"}}' AS rating FROM ({PAYLOADS.sql})")
def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PAYLOADS.frame(spark, sf_dir).select("place_code", F.to_json(records.tagged(F.col("latitude"), F.col("fetched_at"))[0]).alias("rating"))


@query("M05_socials", "SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 2 = 0 THEN 'FACEBOOK=new' ELSE 'FACEBOOK=old' END, CASE WHEN c_custkey % 3 = 0 THEN 'INSTAGRAM=new' END) AS socials FROM customer")
def socials(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    s = records.socials(F.lit("old"), F.lit(None).cast("string"), F.when(k % 2 == 0, "new").otherwise(""), F.when(k % 3 == 0, "new"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.array_join(F.transform(s, lambda x: F.concat(x["platform"], F.lit("="), x["url"])), ",").alias("socials"))


@query("M11_row_merge", f"WITH o AS ({OLD.sql}), p AS ({PAYLOADS.sql}) SELECT o.place_code, CASE WHEN p.status = 'ok' AND p.address <> '' THEN p.address ELSE o.address END AS address, CASE WHEN p.status = 'ok' THEN 'menu1,menu2,' || o.place_code ELSE 'menu1' END AS menu FROM o LEFT JOIN p USING (place_code)")
def row_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed attempt leaves a row untouched; lists grow by what is new."""
    old = OLD.frame(spark, sf_dir).withColumn("menu", F.array(F.lit("menu1")))
    payloads = PAYLOADS.frame(spark, sf_dir).withColumn("menu", F.array(F.lit("menu1"), F.lit("menu2"), F.col("place_code")))
    return records.merged_rows(old, payloads, ["address"], ["menu"]).select("place_code", "address", F.array_join("menu", ",").alias("menu"))


KNOWN_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS place_code, 'GUL-' || lpad((c_custkey % 900 + 1)::VARCHAR, 3, '0') AS cafe_id FROM customer WHERE c_custkey % 17 = 0"


@query(
    "M13_assign_ids",
    f"{WITH_SEED}, known AS ({KNOWN_SQL}), fresh AS (SELECT place_code, row_number() OVER (ORDER BY pos) + (SELECT max(substr(cafe_id, 5)::BIGINT) FROM known) AS n FROM seed WHERE place_code NOT IN (SELECT place_code FROM known)) "
    "SELECT place_code, cafe_id FROM known UNION ALL SELECT place_code, 'GUL-' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END FROM fresh",
)
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 17 = 0")
    known = c.select(F.col("c_custkey").cast("string").alias("place_code"), F.concat(F.lit("GUL-"), F.lpad((F.col("c_custkey") % 900 + 1).cast("string"), 3, "0")).alias("cafe_id"))
    return records.assign_ids(SEED.frame(spark, sf_dir), known)


@query("M14_materialise", f"{WITH_SEED} SELECT s.place_code, s.business_name AS name, CASE WHEN c_custkey IS NULL THEN 'pending' ELSE 'ok' END AS scrape_status FROM seed s LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0) o ON s.pos = o.c_custkey")
def materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = seed_records(spark, sf_dir).select("place_code", "name", "scrape_status")
    stored = SEED.frame(spark, sf_dir).filter("pos % 5 = 0").select("place_code", F.col("business_name").alias("name"), F.lit("ok").alias("scrape_status"))
    return records.upsert(new, stored)


@query("M15_upsert", "SELECT c_custkey AS place_code, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_mktsegment END AS v FROM customer UNION ALL SELECT -1, 'added'")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("place_code"), F.col("c_mktsegment").alias("v"))
    rows = store.filter("place_code % 4 = 0").select("place_code", F.lit("new").alias("v")).union(spark.range(1).select((F.col("id") - 1).alias("place_code"), F.lit("added").alias("v")))
    return records.upsert(store, rows)


GAPS = Input(
    {
        "place_code": "CAST(c_custkey AS STRING)",
        "name": "c_name",
        "menu": "c_custkey % 2 = 0",
        "priced": "c_custkey % 4 = 0",
        "rating": "c_custkey % 3 = 0",
        "reviews": "c_custkey % 5 <> 0",
        "review_count": "c_custkey % 7 <> 0",
        "hours": "c_custkey % 3 <> 1",
        "scrape_status": "CASE c_custkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'out_of_scope' ELSE 'ok' END",
        "business_status": "CASE WHEN c_custkey % 10 = 9 THEN 'PERMANENTLY_CLOSED' ELSE 'OPERATIONAL' END",
        "duplicate_of": "CASE c_custkey % 8 WHEN 7 THEN concat('GUL-', CAST(c_custkey AS STRING)) WHEN 6 THEN '' ELSE NULL END",
    },
    "customer",
)
_MISSING_SQL = "concat_ws(',', CASE WHEN NOT menu THEN 'menu' END, CASE WHEN NOT priced THEN 'price' END, CASE WHEN NOT rating THEN 'rating' END, CASE WHEN NOT reviews THEN 'reviews' END, CASE WHEN NOT review_count THEN 'review_count' END, CASE WHEN NOT hours THEN 'hours' END, CASE WHEN scrape_status = 'pending' THEN 'not_scraped' END)"
_REASON_SQL = "CASE WHEN scrape_status = 'out_of_scope' THEN 'outside the configured scope' WHEN business_status = 'PERMANENTLY_CLOSED' THEN 'permanently closed' WHEN duplicate_of <> '' THEN 'duplicate listing of ' || duplicate_of END"


def gap_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = GAPS.frame(spark, sf_dir)
    missing = records.gaps(*[F.col(c) for c in ("menu", "priced", "rating", "reviews", "review_count", "hours", "scrape_status")])
    return g.select("place_code", "name", "scrape_status", "business_status", "duplicate_of", missing.alias("missing"), records.excluded_reason(F.col("scrape_status"), F.col("business_status"), F.col("duplicate_of")).alias("excluded_reason"))


@query("M21_gaps", f"SELECT place_code, {_MISSING_SQL} AS missing FROM ({GAPS.sql})")
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_records(spark, sf_dir).select("place_code", F.array_join("missing", ",").alias("missing"))


@query("F13_excluded_reason", f"SELECT place_code, {_REASON_SQL} AS reason FROM ({GAPS.sql})")
def excluded_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_records(spark, sf_dir).select("place_code", F.col("excluded_reason").alias("reason"))


_SUMMARY = ", ".join(f"count(*) FILTER (live AND NOT {c}) AS missing_{n}" for n, c in (("menu", "menu"), ("price", "priced"), ("rating", "rating"), ("reviews", "reviews"), ("review_count", "review_count"), ("hours", "hours")))


@query(
    "A01_summary",
    f"SELECT count(*) AS records_total, count(*) FILTER (live) AS live, count(*) FILTER (NOT live) AS excluded, count(*) FILTER (business_status = 'PERMANENTLY_CLOSED') AS permanently_closed, count(*) FILTER (duplicate_of <> '') AS duplicates, {_SUMMARY}, "
    f"count(*) FILTER (live AND scrape_status = 'pending') AS not_scraped_yet, count(*) FILTER (live AND rating) AS with_rating, count(*) FILTER (live AND hours) AS with_hours, count(*) FILTER (live AND reviews) AS with_reviews FROM (SELECT *, ({_REASON_SQL}) IS NULL AS live FROM ({GAPS.sql}))",
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.summary(gap_records(spark, sf_dir))


@query("A01_summary_names", f"SELECT 'hours' AS gap, name FROM ({GAPS.sql}) WHERE ({_REASON_SQL}) IS NULL AND NOT hours UNION ALL SELECT 'rating', name FROM ({GAPS.sql}) WHERE ({_REASON_SQL}) IS NULL AND NOT rating")
def summary_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = gap_records(spark, sf_dir).filter("excluded_reason is null")
    return live.select(F.explode("missing").alias("gap"), "name").filter(F.col("gap").isin("hours", "rating"))


QUEUE = Input(
    {
        "place_code": "CAST(c_custkey AS STRING)",
        "scrape_status": "CASE c_custkey % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'not_found' WHEN 3 THEN 'legacy' WHEN 4 THEN 'out_of_scope' ELSE 'blocked_or_error' END",
        "attempts": "c_custkey % 5",
        "complete": "c_custkey % 4 = 0",
    },
    "customer",
    where="c_custkey % 9 <> 0",
)
PENDING_SQL = f"{WITH_SEED}, q AS ({QUEUE.sql}) SELECT seed.pos, seed.place_code FROM seed LEFT JOIN q USING (place_code) WHERE q.scrape_status IS NULL OR (q.scrape_status = 'ok' AND NOT q.complete AND attempts < 3) OR (q.scrape_status IN ('not_found', 'legacy', 'blocked_or_error') AND attempts < 3)"


@query("F08_pending", PENDING_SQL)
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.pending(SEED.frame(spark, sf_dir).select("pos", "place_code"), QUEUE.frame(spark, sf_dir))


@query("F08_pending_limited", f"SELECT * FROM ({PENDING_SQL}) ORDER BY pos LIMIT 25")
def pending_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.pending(SEED.frame(spark, sf_dir).select("pos", "place_code"), QUEUE.frame(spark, sf_dir), limit=25)


@query("F09_complete", f"SELECT place_code, rating AND review_count AND reviews AND hours AS complete FROM ({GAPS.sql})")
def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_records(spark, sf_dir).select("place_code", (~F.arrays_overlap("missing", F.array(*[F.lit(x) for x in ("rating", "review_count", "reviews", "hours")]))).alias("complete"))


@query("F10_not_accepted", f"WITH x AS ({RESOLVED_SQL}) SELECT place_code FROM x WHERE NOT coalesce({ACCEPTED_SQL}, FALSE)")
def not_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).filter(~F.coalesce("accepted", F.lit(False))).select("place_code")


@query("F12_field_present", f"SELECT place_code, src, coalesce(address, '') <> '' AS has_address, rating IS NOT NULL AS has_rating FROM ({BLOCKS_SQL})")
def field_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir)
    return b.select("place_code", "src", resolution.usable("address", "string").alias("has_address"), resolution.usable("rating", "double").alias("has_rating"))


@query("W06_incremental", f"WITH q AS ({PENDING_SQL}) SELECT coalesce(s.scrape_status, 'pending') AS before, count(*) AS n FROM q LEFT JOIN ({QUEUE.sql}) s USING (place_code) GROUP BY 1")
def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = QUEUE.frame(spark, sf_dir)
    todo = records.pending(SEED.frame(spark, sf_dir).select("pos", "place_code"), store)
    return todo.join(store, "place_code", "left").groupBy(F.coalesce("scrape_status", F.lit("pending")).alias("before")).agg(F.count("*").alias("n"))


@query("W07_attempts", f"WITH o AS ({OLD.sql}), p AS ({PAYLOADS.sql}) SELECT attempts, count(*) AS n FROM (SELECT o.attempts + (p.status IS NOT NULL)::BIGINT AS attempts FROM o LEFT JOIN p USING (place_code)) GROUP BY 1")
def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh(spark, sf_dir).groupBy("attempts").agg(F.count("*").alias("n"))


@query("O05_by_id", "SELECT cafe_id, row_number() OVER (ORDER BY cafe_id) AS place FROM (SELECT 'GUL-' || (c_custkey + 90) AS cafe_id FROM customer)")
def by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("GUL-"), (F.col("c_custkey") + 90).cast("string")).alias("cafe_id"))
    return records.numbered(ids, [F.col("cafe_id")], "place")


@query("U02_source_plugin", f"SELECT src, count(*) AS n FROM ({OBSERVATIONS.sql}) WHERE src IN ('g', 'osm') GROUP BY 1")
def source_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [registry.of_source(OBSERVATIONS.frame, "g"), registry.of_source(OBSERVATIONS.frame, "osm"), registry.of_source(OBSERVATIONS.frame, "fp")._replace(enabled=False)]
    return registry.observations(sources, spark, sf_dir).groupBy("src").agg(F.count("*").alias("n"))


@query("K03_flat_sources", f"SELECT place_code, max(rating) FILTER (src = 'g') AS g_rating, max(phone) FILTER (src = 'g') AS g_phone, max(rating) FILTER (src = 'fp') AS fp_rating, max(phone) FILTER (src = 'fp') AS fp_phone FROM ({BLOCKS_SQL}) GROUP BY 1")
def flat_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.flattened(blocks(spark, sf_dir), ["rating", "phone"], ("g", "fp"))


@query("K09_report", f"WITH x AS ({RESOLVED_SQL}) SELECT place_code, round_even(({_GOT}) / 33.0, 4) AS completeness FROM x ORDER BY completeness DESC, place_code LIMIT 10")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).orderBy(F.desc("completeness"), "place_code").limit(10).select("place_code", "completeness")


