"""Queries of versioned stores: rival writers, older versions, streams folded in, runs from seed to store."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import clusters
from waymark.operators.records import upsert
from waymark.runs import Run, Settings
from waymark.runtime import frozen, new_folder
from waymark.sources.snapshots import Snapshots

from .base import OBSERVATIONS, SEED, query, table
from .guards import in_slices
from .merging import PAYLOADS
from .places import PLACES, REASON_SQL, WITH_SEED, cluster_sql


def added(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("k").agg(F.sum("v").alias("v"))


@query("K04_versions", "SELECT v AS version, count(*) AS records, sum(CASE v WHEN 1 THEN c_custkey WHEN 3 THEN c_custkey + (c_custkey % 2 = 0)::BIGINT + 10 * (c_custkey % 3 = 0)::BIGINT ELSE 1 END)::BIGINT AS total FROM customer, (VALUES (1), (3), (4)) t(v) WHERE v < 4 OR c_custkey % 5 = 0 GROUP BY v")
def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first version; two writers at once, whose changes are both in the third; a replacement. Each is read afterwards."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").alias("v"))
    store = Snapshots(spark, new_folder(spark), "k")
    store.replace(c)
    rivals = [c.filter("k % 2 = 0").select("k", F.lit(1).cast("long").alias("v")), c.filter("k % 3 = 0").select("k", F.lit(10).cast("long").alias("v"))]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda rows: store.upsert(rows, added), rivals))
    store.replace(c.filter("k % 5 = 0").select("k", F.lit(1).cast("long").alias("v")), base=3)
    out = [store.read(v).agg(F.lit(v).alias("version"), F.count("*").alias("records"), F.sum("v").alias("total")) for v in (1, 3, 4)]
    return out[0].union(out[1]).union(out[2])


def visits(rows: DataFrame) -> DataFrame:
    """Per place: how many visits, the last one, the last rating that a visit found."""
    visit = F.struct("ts", "event_id", "status", "rating")
    found = F.when(F.col("rating").isNotNull(), visit)
    return rows.groupBy("place_code").agg(F.count("*").alias("attempts"), F.max(visit).alias("last"), F.max(found).alias("rated"))


def folded(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("place_code").agg(F.sum("attempts").alias("attempts"), F.max("last").alias("last"), F.max("rated").alias("rated"))


@query(
    "W06_stream_upsert",
    f"SELECT place_code, count(*) AS attempts, arg_max(status, (ts, event_id)) AS status, arg_max(rating, (ts, event_id)) FILTER (rating IS NOT NULL) AS rating FROM ({OBSERVATIONS.sql}) GROUP BY 1",
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits arrive as a stream and are folded into stored records, each micro-batch once, though one is given again."""
    rows = OBSERVATIONS.frame(spark, sf_dir).select("event_id", "place_code", "status", "rating", F.col("ts").cast("timestamp").alias("ts"))
    at = new_folder(spark)
    store = Snapshots(spark, f"{at}/records")
    sink = store.sink("visits", folded, visits)

    def twice(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        sink(batch, number)

    in_slices(spark, rows, lambda stream: stream.writeStream.foreachBatch(twice), at)
    return store.read().select("place_code", "attempts", F.col("last.status").alias("status"), F.col("rated.rating").alias("rating"))


@query("J03_increments", cluster_sql(PLACES.sql))
def increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places that come in two lots, the second one in a hundred of all ranks: the leaders are those of all places at once."""
    places = PLACES.frame(spark, sf_dir)
    spots = clusters.no_spots(spark, places)
    for part in (places.filter("rank % 100 <> 7"), places.filter("rank % 100 = 7")):
        spots = frozen(upsert(spots, clusters.reclustered(spots, part), "spot"))
    spot = clusters.spot_of(F.col("id"), F.col("name"), F.col("latitude"), F.col("longitude"))
    return places.select("id", spot.alias("spot")).join(spots.select("spot", "leader_id"), "spot").select("id", "leader_id")


_KEPT = f"SELECT place_code AS id, business_name AS name, latitude, longitude, row_number() OVER (ORDER BY pos) - 1 AS rank FROM (SELECT *, {REASON_SQL} AS reason FROM ({SEED.sql})) WHERE reason IS NULL"


@query(
    "U04_run",
    f"""{WITH_SEED}, c AS ({cluster_sql(_KEPT)}), p AS ({PAYLOADS.sql}), ids AS (SELECT place_code, row_number() OVER (ORDER BY pos) AS n FROM seed),
 named AS (SELECT place_code, 'GUL-' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END AS cafe_id FROM ids)
 SELECT s.place_code, i.cafe_id, CASE WHEN c.id IS NULL THEN 'out_of_scope' ELSE coalesce(p.status, 'pending') END AS scrape_status, (p.status IS NOT NULL)::BIGINT AS attempts,
  CASE WHEN c.id <> c.leader_id THEN l.cafe_id END AS duplicate_of, CASE WHEN p.status IN ('ok', 'legacy') AND p.address <> '' THEN p.address END AS address, CASE WHEN p.status IN ('ok', 'legacy') AND p.latitude <> 0 THEN p.latitude END AS latitude
 FROM seed s JOIN named i USING (place_code) LEFT JOIN c ON c.id = s.place_code LEFT JOIN named l ON l.place_code = c.leader_id LEFT JOIN p ON p.place_code = c.leader_id""",
)
def seed_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a store: the second finds the seed's last rows new. Places are taken in the seed's order, once each."""
    seed = SEED.frame(spark, sf_dir).withColumn("popularity", F.lit(0.0))
    last = seed.agg(F.max("pos")).head()[0]
    run = Run(spark, new_folder(spark), Settings(attempts=1))
    for number, part in enumerate((seed.filter(F.col("pos") * 50 <= F.lit(last or 0) * 49), seed)):
        run.take(part, PAYLOADS.frame(spark, sf_dir), number, f"run {number}")
    return run.records.read().select("place_code", "cafe_id", "scrape_status", "attempts", "duplicate_of", "address", "latitude")
