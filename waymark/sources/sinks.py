"""Exports. A version is written under a new name and then pointed to, so readers never see half of one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.hours import week_columns
from waymark.functions.text import file_slug

from .workbook import write_workbook


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.Path, place.getFileSystem(conf)


def replace_table(df: DataFrame, path: str, kind: str = "parquet", **options: str) -> None:
    """Write ``df`` beside ``path``, keep what was there as ``path``.bak, and move the new version into place. The backup before
    goes last, so at every moment there is the table or a backup. For one writer, on file systems that rename folders at
    once; ``Snapshots`` need neither."""
    at, fs = _fs(df.sparkSession, path)
    staged, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}"
    df.write.format(kind).options(**options).save(staged)
    if fs.exists(at(path)):
        if fs.exists(at(f"{path}.bak")):
            fs.rename(at(f"{path}.bak"), at(old))
        fs.rename(at(path), at(f"{path}.bak"))
    fs.rename(at(staged), at(path))
    fs.delete(at(old), True)


def read_table(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """The table at ``path``, or its backup if a replacement stopped between its two renames."""
    at, fs = _fs(spark, path)
    return spark.read.format(kind).load(path if fs.exists(at(path)) else f"{path}.bak")


def envelope(records: DataFrame, location: str, generated_at: str, version: int = 1) -> DataFrame:
    """One row (json) of counts that goes with a record table; the records stay a table of their own."""
    return records.agg(F.count("*").alias("n")).select(
        F.to_json(F.struct(F.lit(location).alias("location"), F.lit(version).alias("schema_version"), F.lit(generated_at).alias("generated_at"), F.col("n").alias("records"))).alias("json")
    )


def flat_records(records: DataFrame) -> DataFrame:
    """Nested records as text and numbers: week columns, socials as columns, lists joined, reviews as JSON. The rating is the
    platform's own like the count and the hours."""
    own = lambda c: F.try_element_at(F.filter(c, lambda x: x["platform"] == "GOOGLE_MAPS"), F.lit(1))
    social = lambda p: F.try_element_at(F.filter("social_urls", lambda x: x["platform"] == p), F.lit(1))["url"]
    return records.select(
        "cafe_id",
        "place_code",
        "name",
        F.array_join("platforms_found", "+").alias("platforms_found"),
        social("FACEBOOK").alias("facebook_url"),
        social("INSTAGRAM").alias("instagram_url"),
        own("rating")["value"].alias("google_rating"),
        own("review_count")["count"].alias("google_review_count"),
        *week_columns(own("hours")["schedule"]),
        F.to_json("reviews").alias("reviews_json"),
        F.size("reviews").alias("review_snippet_count"),
        F.array_join("missing", ",").alias("missing"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    replace_table(df, path, "csv", header="true", escape='"')


def write_json(df: DataFrame, path: str) -> None:
    replace_table(df, path, "json")


def write_excel(df: DataFrame, path: str) -> None:
    """A workbook of the table; more rows than a sheet holds are an error, not a cut."""
    write_workbook(df, path)


def archive_raw(payloads: DataFrame, path: str) -> None:
    """Raw payloads as JSON, one folder per run, named by place."""
    payloads.withColumn("file", F.concat(file_slug(F.col("place_code")), F.lit("_"), file_slug(F.col("name")))).write.mode("append").partitionBy("run_id").json(path)


def enrich(table: DataFrame, rows: DataFrame, key: str = "place_code") -> DataFrame:
    """``table`` with the columns of ``rows`` added or filled in where ``rows`` has a value."""
    new = [c for c in rows.columns if c != key]
    r = rows.select(key, *[F.col(c).alias(f"_new_{c}") for c in new])
    joined = table.join(r, key, "left")
    old = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in new else F.col(c) for c in table.columns]
    return joined.select(*old, *[F.col(f"_new_{c}").alias(c) for c in new if c not in table.columns])


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A run ledger; empty if there is none; columns that older runs lack are null."""
    at, fs = _fs(spark, path)
    if not fs.exists(at(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mergeSchema", "true").parquet(path)
