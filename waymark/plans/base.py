"""The catalogue of queries, and inputs that Spark and the oracle build from the same expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its operator's id, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        CATALOGUE[name] = (f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Input:
    """Rows made by SQL expressions that both engines understand, over one table or a join of two."""

    def __init__(self, columns: dict[str, str], source: str, join: str | None = None, on: str | None = None, where: str | None = None):
        self.columns, self.source, self.join, self.on, self.where = columns, source, join, on, where

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, self.source)
        if self.join:
            df = df.join(table(spark, sf_dir, self.join), F.expr(self.on))
        if self.where:
            df = df.filter(self.where)
        return df.selectExpr(*[f"{e} AS {c}" for c, e in self.columns.items()])

    @property
    def sql(self) -> str:
        text = f"SELECT {', '.join(f'{e} AS {c}' for c, e in self.columns.items())} FROM {self.source}"
        if self.join:
            text += f" JOIN {self.join} ON {self.on}"
        return text + (f" WHERE {self.where}" if self.where else "")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over two tasks a core where it comes in fewer: for rows of few bytes and much work, of which the reader
    puts millions into one task."""
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def scalar(name: str, raw: str, outputs: dict[str, tuple[Callable[[Column], Column], str]], source: str = "customer", key: str = "c_custkey", much_work: bool = False) -> None:
    """A query that applies functions of one text to a text made of every row's key; the oracle's side is written in its own
    functions. ``much_work``: rows are dealt over all cores first."""
    data = Input({"k": key, "raw": raw}, source)
    sql = f"WITH t AS ({data.sql}) SELECT k, {', '.join(f'{duck} AS {out}' for out, (_, duck) in outputs.items())} FROM t"

    @query(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = data.frame(spark, sf_dir)
        return (spread(rows) if much_work else rows).select("k", *[f(F.col("raw")).alias(out) for out, (f, _) in outputs.items()])


# A seed of places: customers with the names of parts, spread over about one square kilometre.
_K = "c_custkey"
SEED = Input(
    {
        "pos": _K,
        "place_code": f"CAST({_K} AS STRING)",
        "business_name": f"concat(p_name, CASE {_K} % 4 WHEN 0 THEN ' cafe' WHEN 1 THEN ' coffee house' WHEN 2 THEN ' Cafe Gulshan' ELSE '' END)",
        "address": f"CASE WHEN {_K} % 6 = 0 THEN NULL ELSE concat('House ', CAST({_K} % 90 AS STRING), ', Road ', CAST({_K} % 40 AS STRING)) END",
        "sub_area": f"CASE {_K} % 6 WHEN 0 THEN 'Gulshan 1' WHEN 1 THEN 'Gulshan-2' WHEN 2 THEN 'Gulshan' WHEN 3 THEN 'Banani' WHEN 4 THEN 'Circle 2' ELSE NULL END",
        "area": f"CASE WHEN {_K} % 7 = 0 THEN 'Dhaka' ELSE 'Gulshan' END",
        "sub_type": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Cafe' WHEN 'MACHINERY' THEN 'Cyber Cafe' WHEN 'AUTOMOBILE' THEN 'Steakhouse' WHEN 'HOUSEHOLD' THEN NULL ELSE 'Furniture' END",
        "latitude": f"23.78e0 + ({_K} * 37 % 1000) / 1e5",
        "longitude": f"90.41e0 + ({_K} * 91 % 1000) / 1e5",
        "popularity": f"CASE WHEN {_K} % 11 = 0 THEN NULL ELSE c_acctbal END",
        "c_mktsegment": "c_mktsegment",
        "c_nationkey": "c_nationkey",
    },
    "customer",
    "part",
    "c_custkey = p_partkey",
)
# Visits of sources to places: one event each.
OBSERVATIONS = Input(
    {
        "event_id": "event_id",
        "place_code": "CAST(user_id AS STRING)",
        "src": "CASE event_type WHEN 'view' THEN 'g' WHEN 'click' THEN 'fp' WHEN 'purchase' THEN 'ta' WHEN 'signup' THEN 'osm' ELSE CASE WHEN event_id % 2 = 0 THEN 'g' ELSE 'fp' END END",
        "status": "CASE WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 'not_found' WHEN 1 THEN 'blocked_or_error' ELSE 'geo_mismatch' END ELSE 'ok' END",
        "ts": "ts",
        "rating": "CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN NULL ELSE 1.0e0 + (event_id % 41) / 10e0 END",
        "review_count": "CASE WHEN event_type = 'error' OR event_id % 4 = 0 THEN NULL ELSE event_id % 900 END",
        "address": "CASE WHEN event_type = 'error' OR event_id % 3 = 0 THEN '' ELSE concat('Road ', CAST(event_id % 70 AS STRING)) END",
        "phone": "CASE WHEN event_type = 'error' OR event_id % 7 = 0 THEN NULL ELSE concat('+8801', CAST(700000000 + event_id AS STRING)) END",
        "website": "CASE WHEN event_type = 'error' OR event_id % 2 = 0 THEN NULL ELSE concat('https://place', CAST(user_id AS STRING), '.example.com') END",
        "business_status": "CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 97 = 0 THEN 'PERMANENTLY_CLOSED' WHEN event_id % 5 = 1 THEN 'UNKNOWN' ELSE 'OPERATIONAL' END",
        "latitude": "CASE WHEN event_type = 'error' THEN NULL ELSE 23.78e0 + (user_id * 37 % 1000) / 1e5 END",
    },
    "events",
)
HAVERSINE_SQL = "2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2) + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2))))"
TOKENS_SQL = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda t: length(t) > 2))"


def jaccard_sql(a: str, b: str) -> str:
    """Over two token lists, by counting shared tokens."""
    same = f"len(list_filter({a}, lambda t: list_contains({b}, t)))"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE {same}::DOUBLE / (len({a}) + len({b}) - {same}) END"
