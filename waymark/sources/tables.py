"""Seed tables, stores, raw runs, databases and settings."""

from __future__ import annotations

import copy
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.dates import run_stamp
from waymark.functions.numbers import number
from waymark.functions.values import blank_to_null

# Header names of seed files, first choice first.
SEED_HEADERS = {
    "place_code": ("place_code", "ucode", "id"),
    "business_name": ("business_name", "name", "place_name"),
    "latitude": ("latitude", "lat"),
    "longitude": ("longitude", "lng", "lon"),
    "address": ("address", "full_address"),
    "sub_area": ("sub_area", "subarea"),
    "area": ("area",),
    "city": ("city",),
    "sub_type": ("sub_type", "subtype"),
    "popularity": ("popularity_ranking", "popularity"),
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, a byte-order mark removed from the first header; quoted fields may span lines."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_csv_filled(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text with '' for what is missing."""
    return read_csv(spark, path).na.fill("")


def read_csv_typed(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Columns with inferred types; rows without a required value are dropped."""
    return spark.read.csv(path, header=True, inferSchema=True, multiLine=True, escape='"').dropna(subset=required)


def _headers(df: DataFrame) -> dict[str, str]:
    return {c.strip().lower(): c for c in df.columns}


def field(df: DataFrame, *names: str) -> Column:
    """The first of the named columns with something in it, row by row, trimmed; headers in any case and with blanks around."""
    have = _headers(df)
    found = [blank_to_null(F.col(f"`{have[n]}`").cast("string")) for n in names if n in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def column_named(df: DataFrame, *names: str) -> str | None:
    """The first named column that the table has, for the whole table."""
    have = _headers(df)
    return next((have[n] for n in names if n in have), None)


def seed_rows(df: DataFrame) -> DataFrame:
    """Seed rows with a code, a name and a finite place; others are dropped. Missing popularity is 0, so it sorts first."""
    out = df.select(*[(number(field(df, *names)) if c in ("latitude", "longitude") else field(df, *names)).alias(c) for c, names in SEED_HEADERS.items()], *(["pos"] if "pos" in df.columns else []))
    known = out.filter("place_code is not null and business_name is not null and latitude is not null and longitude is not null")
    return known.withColumn("popularity", number(F.coalesce("popularity", F.lit("0"))))


def read_store(spark: SparkSession, path: str, schema: T.StructType, backup: str | None = None) -> DataFrame:
    """Records of a JSON store; of its backup if the store is missing or is no JSON; else an empty table."""
    wrapped = T.StructType([T.StructField("records", T.ArrayType(schema)), T.StructField("_bad", T.StringType())])
    for p in (path, backup):
        if not p:
            continue
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(p)
        if not place.getFileSystem(conf).exists(place):
            continue
        raw = spark.read.schema(wrapped).json(p, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
        if raw.filter("_bad is not null or records is null").isEmpty():
            return raw.select(F.inline("records"))
    return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Profiles of all run folders: the profile's columns, run_at (from the folder), path, and place_code (the profile's,
    else the file name before the first _)."""
    raw = spark.read.schema(schema).json(f"{root}/run_*/profiles/*.json", multiLine=True, mode="DROPMALFORMED")
    path = F.col("_metadata.file_path")
    stem = F.split(F.element_at(F.split(path, "/"), -1), r"[_.]")[0]
    run = F.regexp_replace(path, "/profiles/[^/]*$", "")
    return raw.select(*[c for c in raw.columns if c != "place_code"], path.alias("path"), run_stamp(run).alias("run_at"), F.coalesce(blank_to_null(F.col("place_code")), stem).alias("place_code"))


def brand_pattern(brand: str) -> str:
    """A LIKE pattern for texts that contain the brand; its own wildcards stand for themselves (escaped by a backslash)."""
    return "%" + re.sub(r"([\\%_])", r"\\\1", brand) + "%"


def outlets_query(brand: str, table: str = "public.places", ilike: bool = True) -> str:
    """The statement that the database runs: places whose name contains the brand in any case. Without ``ilike``, for databases
    that do not have it, both sides are lower-cased."""
    literal = brand_pattern(brand).replace("'", "''")
    test = f"business_name ILIKE '{literal}'" if ilike else f"LOWER(business_name) LIKE LOWER('{literal}')"
    return f"SELECT * FROM {table} WHERE {test} ESCAPE '\\'"


def read_outlets(
    spark: SparkSession, url: str, brand: str, properties: dict[str, str] | None = None, table: str = "public.places", ilike: bool = True, parts: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """Places whose name contains the brand in any case; the predicate runs in the database, and so do filters and the choice of
    columns that are put on what is returned. ``parts`` (column, from, to, number) reads in so many queries, each of a range
    of a numeric column; rows outside of the bounds are in the first and last."""
    statement = outlets_query(brand, table, ilike)
    if parts is None:
        return spark.read.format("jdbc").options(url=url, query=statement, **(properties or {})).load()
    column, lo, hi, n = parts
    ranges = {"partitionColumn": column, "lowerBound": str(lo), "upperBound": str(hi), "numPartitions": str(n)}
    return spark.read.format("jdbc").options(url=url, dbtable=f"({statement}) outlets", **ranges, **(properties or {})).load()


def merged_settings(defaults: dict, given: dict) -> dict:
    """``given`` over ``defaults``: tables merge, lists and values replace, unknown keys stay."""
    out = copy.deepcopy(defaults)
    for k, v in given.items():
        out[k] = merged_settings(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def selectors(defaults: dict[str, list[str]], given: dict[str, list[str]] | None) -> dict[str, list[str]]:
    """Configured selector lists over the defaults; empty lists are ignored."""
    return {**defaults, **{k: v for k, v in (given or {}).items() if v}}


