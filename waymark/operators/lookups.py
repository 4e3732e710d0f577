"""Rows joined to what is stored about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, payloads: DataFrame, key: str = "place_code") -> DataFrame:
    """All rows, with the payload of their key where there is one. ``payloads`` has one row a key; a null key finds none."""
    return rows.join(payloads, key, "left")


def with_fallback(rows: DataFrame, extra: DataFrame, key: str, column: str, fallback: Column) -> DataFrame:
    """Rows whose ``column`` is null take ``fallback``, an expression over the row of ``extra`` with their key; the others keep theirs."""
    own = rows.withColumn("_needs", F.col(column).isNull())
    joined = own.join(extra, key, "left")
    return joined.select(*[F.when(F.col("_needs"), fallback).otherwise(F.col(c)).alias(c) if c == column else c for c in rows.columns])


def not_stored(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the stored ones; a null key is not."""
    return rows.join(stored.select(key), key, "left_anti")
