"""Queries of scope, order, matching and clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.values import is_empty
from waymark.operators import lookups, matching, records, scope
from waymark.sources import tables

from .base import HAVERSINE_SQL, SEED, TOKENS_SQL, Input, jaccard_sql, query, table

WITH_SEED = f"WITH seed AS ({SEED.sql})"
REASON_SQL = """CASE WHEN contains(lower(coalesce(sub_type, '')), 'cyber') THEN 'sub_type matched exclusion pattern ''cyber'''
 WHEN coalesce(sub_type, '') <> '' AND NOT regexp_matches(lower(sub_type), 'cafe|café|coffee|bakery|tea|dessert|patisserie|pastry') THEN 'sub_type ''' || sub_type || ''' is not a cafe type'
 WHEN NOT contains(lower(coalesce(sub_area, '') || ' ' || coalesce(area, '')), 'gulshan') THEN 'area ''' || coalesce(area, 'None') || '/' || coalesce(sub_area, 'None') || ''' is outside scope' END"""


@query("F01_scope_reason", f"{WITH_SEED} SELECT place_code, {REASON_SQL} AS reason FROM seed")
def scope_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEED.frame(spark, sf_dir).select("place_code", scope.scope_reason().alias("reason"))


@query("F02_split_by_reason", f"{WITH_SEED}, r AS (SELECT *, {REASON_SQL} AS reason FROM seed) SELECT coalesce(reason, 'kept') AS outcome, count(*) AS n FROM r GROUP BY 1")
def split_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, out = scope.split_by_reason(SEED.frame(spark, sf_dir), scope.scope_reason())
    return kept.select(F.lit("kept").alias("outcome")).union(out.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query("F02_excluded_rows", f"{WITH_SEED}, r AS (SELECT *, {REASON_SQL} AS reason FROM seed) SELECT business_name AS name, place_code, reason FROM r WHERE reason IS NOT NULL")
def excluded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.split_by_reason(SEED.frame(spark, sf_dir), scope.scope_reason())[1].select(F.col("business_name").alias("name"), "place_code", "reason")


AREA_SQL = "CASE WHEN regexp_matches(h, 'gulshan[ -]1|circle 1') THEN 'Gulshan-1' WHEN regexp_matches(h, 'gulshan[ -]2|circle 2') THEN 'Gulshan-2' WHEN contains(h, 'gulshan') THEN 'Other Gulshan' END"


@query("M02_named_area", f"{WITH_SEED}, h AS (SELECT place_code, lower(coalesce(sub_area, '') || ' ' || coalesce(area, '')) AS h FROM seed) SELECT place_code, {AREA_SQL} AS area FROM h")
def named_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEED.frame(spark, sf_dir).select("place_code", scope.named_area(F.col("sub_area"), F.col("area")).alias("area"))


@query("F03_adaptive_filter", f"{WITH_SEED}, m AS (SELECT *, regexp_matches(lower(business_name), 'anvil|gizmo') AS hit, regexp_matches(lower(business_name), 'no such word') AS none FROM seed) SELECT place_code, 'words' AS kind FROM m WHERE hit UNION ALL SELECT place_code, 'too few' FROM m")
def adaptive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = SEED.frame(spark, sf_dir)
    low = F.lower("business_name")
    some = scope.adaptive_filter(seed, low.rlike("anvil|gizmo")).select("place_code", F.lit("words").alias("kind"))
    return some.union(scope.adaptive_filter(seed, low.rlike("no such word")).select("place_code", F.lit("too few").alias("kind")))


@query("F04_type_filter", f"{WITH_SEED} SELECT place_code, 'types' AS kind FROM seed WHERE lower(trim(sub_type)) IN ('cafe', 'cyber cafe') UNION ALL SELECT place_code, 'words' FROM seed WHERE regexp_matches(lower(business_name), 'coffee|cafe')")
def type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed, name = SEED.frame(spark, sf_dir), F.col("business_name")
    types = scope.type_filter(seed, "sub_type", ("cafe", "cyber cafe"), name, "coffee|cafe").select("place_code", F.lit("types").alias("kind"))
    return types.union(scope.type_filter(seed, "sub_type", ("no such type",), name, "coffee|cafe").select("place_code", F.lit("words").alias("kind")))


@query("F05_typed_places", f"{WITH_SEED} SELECT place_code FROM seed WHERE regexp_matches(lower(coalesce(sub_type, '')), 'cafe') AND trim(business_name) <> '' AND latitude IS NOT NULL")
def typed_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.lower(F.coalesce("sub_type", F.lit(""))).rlike("cafe")
    return SEED.frame(spark, sf_dir).filter(kind & ~is_empty(F.col("business_name"), ()) & F.col("latitude").cast("string").try_cast("double").isNotNull()).select("place_code")


# Order -----------------------------------------------------------------------------------------------------------
@query("O01_popularity_order", f"{WITH_SEED} SELECT place_code, row_number() OVER (ORDER BY popularity NULLS LAST, pos) AS place FROM seed")
def popularity_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.numbered(SEED.frame(spark, sf_dir), scope.popularity_keys(), "place").select("place_code", "place")


@query("O02_rank_or_score", f"{WITH_SEED}, r AS (SELECT place_code, pos, CAST(pos + 1 AS DOUBLE) AS rank, popularity FROM seed) SELECT place_code, rank AS as_rank, -popularity AS as_score FROM r")
def rank_or_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = SEED.frame(spark, sf_dir).withColumn("rank", (F.col("pos") + 1).cast("double"))
    by_rank = scope.rank_or_score(seed, "rank").select("place_code", F.col("sort_key").alias("as_rank"))
    return by_rank.join(scope.rank_or_score(seed).select("place_code", F.col("sort_key").alias("as_score")), "place_code")


@query("O03_popularity_or_file", f"{WITH_SEED} SELECT place_code, popularity AS by_value, CAST(NULL AS DOUBLE) AS by_file FROM seed")
def popularity_or_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = SEED.frame(spark, sf_dir).withColumn("zero", F.lit(0.0))
    by_value = scope.popularity_or_file_order(seed).select("place_code", F.col("sort_key").alias("by_value"))
    return by_value.join(scope.popularity_or_file_order(seed, "zero").select("place_code", F.col("sort_key").alias("by_file")), "place_code")


@query("O06_top_n", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(20).select("c_custkey", "c_acctbal")


@query("O07_distinct_first", f"{WITH_SEED} SELECT min(pos) AS pos, lower(business_name) AS name FROM seed GROUP BY 2")
def distinct_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.first_by(SEED.frame(spark, sf_dir).withColumn("name", F.lower("business_name")), ["name"], ["pos"]).select("pos", "name")


@query("O08_batches", "SELECT batch, count(*) AS n, min(c_custkey) AS first FROM (SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 10) AS BIGINT) AS batch FROM customer) GROUP BY 1")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.batches(table(spark, sf_dir, "customer"), 10, [F.col("c_custkey")]).groupBy("batch").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


@query("O10_round_robin", "SELECT slot, count(*) AS n FROM (SELECT (CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 10) AS BIGINT)) % 3 AS slot FROM customer) GROUP BY 1")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = records.batches(table(spark, sf_dir, "customer"), 10, [F.col("c_custkey")])
    return b.groupBy(F.pmod("batch", F.lit(3)).alias("slot")).agg(F.count("*").alias("n"))


@query("A06_dominant", "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1")
def dominant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.dominant(table(spark, sf_dir, "customer"), "c_mktsegment")


# Matching --------------------------------------------------------------------------------------------------------
CANDIDATES = Input(
    {"k": "c_custkey", "score": "(c_custkey * 7 % 101) / 1e2", "distance": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_custkey * 29 % 1500) * 1e0 END", "vendor": "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Blue Door Tea' ELSE c_name END"},
    "customer",
)


@query(
    "J01_classify",
    f"""WITH t AS ({CANDIDATES.sql}), rules(i, needs_name, needs_distance, below_name, confidence, status) AS (VALUES
 (1, 0.6, 300.0, NULL, 'high', 'ok'), (2, 0.4, 800.0, NULL, 'medium', 'ok'), (3, -1.0, 1200.0, 0.45, 'low', 'geo_mismatch'), (4, -1.0, 1200.0, NULL, 'low', 'ok')),
 hit AS (SELECT k, min(i) AS i FROM t JOIN rules ON score >= needs_name AND distance <= needs_distance AND (below_name IS NULL OR score < below_name) GROUP BY 1)
 SELECT t.k, coalesce(r.confidence, 'low') AS confidence, coalesce(r.status, CASE WHEN distance IS NULL THEN 'no_match' ELSE 'geo_mismatch' END) AS status FROM t LEFT JOIN hit USING (k) LEFT JOIN rules r USING (i)""",
)
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CANDIDATES.frame(spark, sf_dir).withColumn("m", matching.classify(F.col("score"), F.col("distance"))).select("k", "m.confidence", "m.status")


@query("J07_misplaced", f"WITH t AS ({CANDIDATES.sql}) SELECT k FROM t WHERE distance > 1200 AND score < 0.45")
def misplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CANDIDATES.frame(spark, sf_dir).filter(matching.misplaced(F.col("score"), F.col("distance"))).select("k")


@query("J08_vendor_name", f"WITH t AS ({CANDIDATES.sql}) SELECT k, CASE WHEN vendor = '' THEN FALSE WHEN vendor = 'Blue Door Tea' THEN FALSE ELSE TRUE END AS mismatch FROM t")
def vendor_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CANDIDATES.frame(spark, sf_dir).select("k", matching.vendor_mismatch(F.lit("Blue Door"), F.col("vendor")).alias("mismatch"))


@query("A09_bounding_box", f"{WITH_SEED} SELECT round(min(latitude) - 0.004, 6) AS south, round(min(longitude) - 0.004, 6) AS west, round(max(latitude) + 0.004, 6) AS north, round(max(longitude) + 0.004, 6) AS east FROM seed")
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = matching.bounding_box(SEED.frame(spark, sf_dir))
    return box.select(*[F.round(c, 6).alias(c) for c in box.columns])


POOL = Input(
    {"id": "s_suppkey", "pos": "s_suppkey", "name": "concat(p_name, CASE s_suppkey % 2 WHEN 0 THEN ' restaurant' ELSE '' END)", "latitude": "23.78e0 + (s_suppkey * 41 % 1000) / 1e5", "longitude": "90.41e0 + (s_suppkey * 83 % 1000) / 1e5"},
    "supplier",
    "part",
    "s_suppkey = p_partkey",
)


@query(
    "J02_best_match",
    f"""{WITH_SEED}, s AS (SELECT *, {TOKENS_SQL.format('business_name')} AS a FROM seed), p AS (SELECT *, {TOKENS_SQL.format('name')} AS b FROM ({POOL.sql})),
 m AS (SELECT s.pos, p.pos AS p_pos, {jaccard_sql('a', 'b')} AS sim, {HAVERSINE_SQL.format(a='s', b='p')} AS dist FROM s, p),
 r AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY sim - dist / 220 * 0.25 DESC, p_pos) AS rn FROM m WHERE dist <= 220 AND sim >= 0.34)
 SELECT pos AS id, p_pos AS match_id, round(sim, 6) AS score, round(dist, 3) AS metres FROM r WHERE rn = 1""",
)
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = SEED.frame(spark, sf_dir).select(F.col("pos").alias("id"), F.col("business_name").alias("name"), "latitude", "longitude")
    found = matching.best_match(left, POOL.frame(spark, sf_dir))
    return found.select("id", F.col("r_id").alias("match_id"), F.round("score", 6).alias("score"), F.round("distance", 3).alias("metres"))


PLACES = Input(
    {"id": "CAST(p_partkey AS STRING)", "name": "p_name", "latitude": "23.78e0 + (p_partkey * 37 % 1000) / 1e5", "longitude": "90.41e0 + (p_partkey * 91 % 1000) / 1e5", "rank": "p_partkey"},
    "part",
)


def cluster_sql(places: str) -> str:
    """(id, leader_id) by SQL, of places (id, name, latitude, longitude, rank: 0, 1, ...)."""
    return f"""WITH RECURSIVE p AS (SELECT *, {TOKENS_SQL.format('name')} AS t FROM ({places})),
 e AS (SELECT b.rank AS later, list(a.rank) AS earlier FROM p a JOIN p b ON a.rank < b.rank WHERE {jaccard_sql('a.t', 'b.t')} >= 0.8 AND {HAVERSINE_SQL.format(a='a', b='b')} <= 150 GROUP BY 1),
 n AS (SELECT p.rank, coalesce(e.earlier, []) AS earlier FROM p LEFT JOIN e ON e.later = p.rank),
 step(rank, leaders) AS (SELECT CAST(-1 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
  SELECT n.rank, CASE WHEN list_has_any(n.earlier, s.leaders) THEN s.leaders ELSE list_append(s.leaders, n.rank) END FROM step s JOIN n ON n.rank = s.rank + 1),
 led AS (SELECT leaders FROM step ORDER BY rank DESC LIMIT 1)
 SELECT o.id, l.id AS leader_id FROM (SELECT n.rank, CASE WHEN list_contains(led.leaders, n.rank) THEN n.rank ELSE list_min(list_intersect(n.earlier, led.leaders)) END AS lead FROM n, led) x JOIN p o ON o.rank = x.rank JOIN p l ON l.rank = x.lead"""


CLUSTER_SQL = cluster_sql(PLACES.sql)



@query("J03_cluster", CLUSTER_SQL)
def cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.cluster_duplicates(PLACES.frame(spark, sf_dir)).select("id", "leader_id")


@query("A11_alias_count", f"SELECT count(*) AS places, count(DISTINCT leader_id) AS leaders, count(*) FILTER (id <> leader_id) AS aliases FROM ({CLUSTER_SQL})")
def alias_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = matching.cluster_duplicates(PLACES.frame(spark, sf_dir))
    return c.agg(F.count("*").alias("places"), F.countDistinct("leader_id").alias("leaders"), F.count_if(F.col("id") != F.col("leader_id")).alias("aliases"))


@query("J04_propagate", f"WITH c AS ({CLUSTER_SQL}), r AS (SELECT CAST(p_partkey AS VARCHAR) AS id, 'GUL-' || p_partkey AS record_id, p_brand AS phone FROM part) SELECT c.id, r.record_id, CASE WHEN c.id <> c.leader_id THEN c.leader_id END AS duplicate_of, CASE WHEN c.id <> c.leader_id THEN l.record_id END AS duplicate_of_record, l.phone FROM c JOIN r ON r.id = c.id JOIN r l ON l.id = c.leader_id")
def propagate(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = matching.cluster_duplicates(PLACES.frame(spark, sf_dir))
    own = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("GUL-"), F.col("p_partkey").cast("string")).alias("record_id"), F.col("p_brand").alias("phone"))
    return matching.propagate(own, clusters, ["phone"])


@query("J05_lookup", f"{WITH_SEED} SELECT s.place_code, e.n FROM seed s LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON s.place_code = CAST(e.user_id AS VARCHAR)")
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("place_code")).agg(F.count("*").alias("n"))
    return lookups.lookup(SEED.frame(spark, sf_dir), n).select("place_code", "n")


@query("J06_fallback_reviews", "WITH own AS (SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN NULL ELSE lang END AS own FROM documents), extra AS (SELECT doc_id, quality FROM labels) SELECT o.doc_id, coalesce(o.own, 'extra ' || e.quality) AS review FROM own o LEFT JOIN extra e USING (doc_id)")
def fallback_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") % 3 != 0, F.col("lang")).alias("review"))
    return lookups.with_fallback(own, table(spark, sf_dir, "labels"), "doc_id", "review", F.concat(F.lit("extra "), F.col("quality").cast("string")))


@query("J10_not_stored", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey % 7 = 0)")
def not_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "orders").filter("o_orderkey % 7 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.not_stored(table(spark, sf_dir, "customer"), stored, "c_custkey").select("c_custkey")


# Settings ---------------------------------------------------------------------------------------------------------
DEFAULTS = {"scope": {"areas": ["gulshan"], "sub_areas": ["gulshan 1", "gulshan 2", "gulshan"], "excluded": ["cyber"], "require_cafe": True}, "limits": {"reviews": 5}}
GIVEN = {"scope": {"areas": ["dhaka", "gulshan"], "sub_areas": ["banani", "circle 2"], "excluded": []}, "unknown": {"kept": 1}}


@query(
    "S11_settings",
    f"{WITH_SEED}, h AS (SELECT *, lower(coalesce(sub_area, '') || ' ' || coalesce(area, '')) AS h FROM seed) SELECT place_code, CASE WHEN coalesce(sub_type, '') <> '' AND NOT regexp_matches(lower(sub_type), 'cafe|café|coffee|bakery|tea|dessert|patisserie|pastry') THEN 'type' "
    "WHEN NOT regexp_matches(h, 'dhaka|gulshan') THEN 'area' WHEN NOT regexp_matches(h, 'banani|circle 2') THEN 'sub_area' END AS rule, 5::BIGINT AS reviews FROM h",
)
def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings over the defaults decide the scope: given lists replace, what is not given stays."""
    merged = tables.merged_settings(DEFAULTS, GIVEN)
    s = merged["scope"]
    chosen = scope.Scope(tuple(s["areas"]), tuple(s["sub_areas"]), tuple(s["excluded"]), s["require_cafe"])
    reason = scope.scope_reason(chosen)
    rule = F.when(reason.startswith("sub_type"), "type").when(reason.startswith("area"), "area").when(reason.startswith("sub_area"), "sub_area")
    return SEED.frame(spark, sf_dir).select("place_code", rule.alias("rule"), F.lit(merged["limits"]["reviews"]).cast("long").alias("reviews"))
