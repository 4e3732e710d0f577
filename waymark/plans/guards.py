"""Queries of quotas, breakers and request streams; hosts are the users of ``events``, errors are soft failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.runtime import new_folder
from waymark.sources.snapshots import Snapshots
from waymark.streaming import breaker as breaker_
from waymark.streaming import guard
from waymark.streaming import quota as quota_

from .base import query, table


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("host"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("failed"), "event_type")


SPEND_SQL = "SELECT CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS day, user_id AS host, count(*) AS used FROM events GROUP BY 1, 2"


@query("A10_daily_spend", f"WITH s AS ({SPEND_SQL}) SELECT day, host, used, greatest(0, 4 - used) AS remaining FROM s WHERE day IN (SELECT day FROM s GROUP BY 1 ORDER BY 1 DESC LIMIT 14)")
def daily_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.remaining(guard.spend(requests(spark, sf_dir)), F.lit(4).cast("long")).withColumn("day", F.col("day").cast("string"))


@query("W01_quota", "SELECT event_id, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) <= 2 AS allowed FROM events")
def quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.within_quota(requests(spark, sf_dir), F.lit(2), "event_id").select("event_id", "allowed")


@query("W02_retention", f"WITH s AS ({SPEND_SQL}) SELECT count(DISTINCT day) AS days, min(day) AS oldest FROM s WHERE day IN (SELECT day FROM s GROUP BY 1 ORDER BY 1 DESC LIMIT 14)")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.spend(requests(spark, sf_dir)).agg(F.countDistinct("day").alias("days"), F.min("day").cast("string").alias("oldest"))


BREAKER_SQL = """WITH RECURSIVE e AS (SELECT event_id, user_id AS host, ts, event_type = 'error' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
 w AS (SELECT e.*, 0 AS before, CAST(NULL AS TIMESTAMP) AS shut, 0 AS fails, CAST('start' AS VARCHAR) AS decision FROM (SELECT DISTINCT host, 0 AS i, CAST(-1 AS BIGINT) AS event_id, CAST(NULL AS TIMESTAMP) AS ts, FALSE AS failed FROM e) e
 UNION ALL SELECT e.host, e.i, e.event_id, e.ts, e.failed, b.before,
  CASE WHEN e.ts < w.shut THEN w.shut WHEN e.failed AND b.before + 1 >= 2 THEN e.ts + INTERVAL 36 HOUR END,
  CASE WHEN e.ts < w.shut THEN w.fails WHEN e.failed THEN b.before + 1 ELSE 0 END,
  CASE WHEN e.ts < w.shut THEN 'skipped' WHEN NOT e.failed THEN 'ok' WHEN b.before + 1 >= 2 THEN 'opened' ELSE 'failed' END
 FROM w JOIN e ON e.host = w.host AND e.i = w.i + 1, LATERAL (SELECT CASE WHEN w.shut IS NOT NULL AND e.ts >= w.shut THEN 0 ELSE w.fails END AS before) b)
 SELECT event_id, host, decision, fails::INT AS fails FROM w WHERE i > 0"""


@query("W03_breaker", BREAKER_SQL)
def breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker_.breaker_batch(requests(spark, sf_dir), 2, 36 * 3600)


@query("W09_breaker_state", f"WITH b AS ({BREAKER_SQL}) SELECT host, count(*) FILTER (decision = 'skipped') AS skipped, count(*) FILTER (decision = 'opened') AS opened FROM b GROUP BY 1")
def breaker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda d: F.count_if(F.col("decision") == d)
    return breaker(spark, sf_dir).groupBy("host").agg(n("skipped").alias("skipped"), n("opened").alias("opened"))


@query("W04_hard_block", "SELECT event_id FROM (SELECT event_id, coalesce(sum(CASE WHEN event_type = 'error' AND event_id % 9 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM events) WHERE b = 0")
def hard_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.before_hard_block(requests(spark, sf_dir), F.col("failed") & (F.col("event_id") % 9 == 0), "event_id").select("event_id")


@query("W05_gaps", "SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap_us FROM events")
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.since_last(requests(spark, sf_dir), "event_id").select("event_id", "gap_us")


def in_slices(spark: SparkSession, rows: DataFrame, start, at: str, n: int = 3) -> None:
    """Runs a stream over ``rows`` in ``n`` runs: each finds one more slice of time in its folder, and goes on from where the run
    before it ended. ``start`` makes the writer for the stream."""
    lo, hi = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).head()
    step = (hi - lo) // n + 1 if lo is not None else 1
    for i in range(n):
        part = rows.filter(F.floor((F.unix_micros("ts") - F.lit(lo)) / step) == i)
        part.write.mode("append").parquet(f"{at}/in")
        with guard.stateful(spark):
            run = start(spark.readStream.schema(rows.schema).parquet(f"{at}/in")).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
        run.awaitTermination()


def _decided(spark: SparkSession, rows: DataFrame, make) -> DataFrame:
    """The rows that a stream puts out over three runs."""
    at = new_folder(spark)

    def keep(out: DataFrame, batch: int) -> None:
        out.write.mode("overwrite").parquet(f"{at}/out/batch={batch}")

    in_slices(spark, rows, lambda stream: make(stream).writeStream.outputMode("append").foreachBatch(keep), at)
    return spark.read.parquet(f"{at}/out").drop("batch")


@query("W01_spend_stream", f"SELECT * FROM ({SPEND_SQL})")
def spend_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger that a stream of requests keeps; every fourth request comes twice."""
    at, rows = new_folder(spark), requests(spark, sf_dir)
    store = Snapshots(spark, f"{at}/spend", ["day", "host"])
    again = rows.unionAll(rows.filter("event_id % 4 = 0"))
    in_slices(spark, again, lambda stream: quota_.ledger(stream, store), at)
    return store.read().withColumn("day", F.col("day").cast("string"))


@query("W02_ledger_days", f"WITH s AS ({SPEND_SQL}) SELECT host, sum(used)::BIGINT AS used, count(*) AS days FROM s WHERE day IN (SELECT day FROM s GROUP BY 1 ORDER BY 1 DESC LIMIT 14) GROUP BY 1")
def ledger_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest days of a ledger kept batch by batch."""
    store = Snapshots(spark, new_folder(spark), ["day", "host"])
    rows = requests(spark, sf_dir)
    for i in range(3):
        store.upsert(quota_.daily(rows.filter(F.col("event_id") % 3 == i)), quota_.spent, "spend", i)
    return guard.newest_days(store.read()).groupBy("host").agg(F.sum("used").alias("used"), F.count("*").alias("days"))


@query("W01_quota_stream", "SELECT event_id, CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS day, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) <= 2 AS allowed FROM events")
def quota_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests(spark, sf_dir)
    again = rows.unionAll(rows.filter("event_id % 5 = 0"))
    return _decided(spark, again, lambda stream: quota_.quota_stream(stream, F.lit(2))).select("event_id", F.col("day").cast("string").alias("day"), "allowed")


@query("W03_breaker_stream", BREAKER_SQL)
def breaker_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _decided(spark, requests(spark, sf_dir), lambda stream: breaker_.breaker_stream(stream, 2, 36 * 3600))
    return out.filter("event_id is not null").select("event_id", "host", "decision", "fails")


@query(
    "W09_cooldowns",
    f"""WITH b AS ({BREAKER_SQL}), o AS (SELECT b.host, e.ts + INTERVAL 36 HOUR AS until FROM b JOIN events e USING (event_id) WHERE decision = 'opened'),
 last AS (SELECT user_id AS host, max(ts) AS ts FROM events GROUP BY 1)
 SELECT o.host, count(*) AS closed, max(epoch_us(until)) AS last_us FROM o JOIN last USING (host) WHERE until <= last.ts OR until < (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1""",
)
def cooldowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of cooldowns: by the next request of the host, or by a timer once event time has passed them."""
    out = _decided(spark, requests(spark, sf_dir), lambda stream: breaker_.breaker_stream(stream, 2, 36 * 3600))
    return out.filter("decision = 'closed'").groupBy("host").agg(F.count("*").alias("closed"), F.max(F.unix_micros("at")).alias("last_us"))
