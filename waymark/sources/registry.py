"""Sources of observations: a contract that every one keeps, and their union."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of an observation that every source must give, with their types; others may be missing and are then null.
REQUIRED = {"place_code": "string", "src": "string", "status": "string", "ts": "timestamp"}


class Source(NamedTuple):
    """A source: its name, what reads its observations, and whether it is switched on."""

    name: str
    read: Callable[[SparkSession, str], DataFrame]
    enabled: bool = True


class BrokenContract(ValueError):
    """A source does not give what an observation needs."""


def checked(source: Source, df: DataFrame) -> DataFrame:
    """``df`` if it keeps the contract; its types are compared without running it. Dates and times without a zone count as times."""
    kinds = dict(df.dtypes)
    for column, kind in REQUIRED.items():
        if column not in kinds:
            raise BrokenContract(f"source {source.name} has no column {column}")
        if kinds[column].replace("_ntz", "") != kind:
            raise BrokenContract(f"source {source.name}: {column} is {kinds[column]}, not {kind}")
    return df


def observations(sources: Iterable[Source], spark: SparkSession, place: str) -> DataFrame:
    """The observations of all enabled sources, united by column name. Names are unique; no source at all is an error."""
    enabled = [s for s in sources if s.enabled]
    if len({s.name for s in enabled}) < len(enabled):
        raise BrokenContract("two sources have one name")
    if not enabled:
        raise BrokenContract("no source is enabled")
    first, *rest = [checked(s, s.read(spark, place)) for s in enabled]
    for more in rest:
        first = first.unionByName(more, allowMissingColumns=True)
    return first


def of_source(read: Callable[[SparkSession, str], DataFrame], name: str) -> Source:
    """One source out of a table that holds several."""
    return Source(name, lambda spark, place: read(spark, place).filter(F.col("src") == name))
