"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is two aggregations and a join, and replaces edges by at most as many; the number of steps grows with
the logarithm of the longest path. Nothing is collected but a row count and a checksum. A node with a great share of all
edges is joined by broadcast in the large step (see skew), so its edges never meet in one task; after it a node has an
edge for each of its neighbours' least ones only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import frozen
from .skew import skew_join


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v; longs): the smallest node reachable.

    Null ends and loops are left out; repeated and reversed edges count once. An empty table gives an empty one. ``rows``:
    a bound of the number of edges, if one is known.
    """
    e = frozen(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows)
    state = _state(e)
    while state[0]:  # edges never grow in number, so their count bounds every later table
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = skew_join(both.filter("v > u"), least, ["u"], "n", 2 * state[0]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = frozen(large.distinct(), state[0])
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = frozen(small.union(least.select("u", F.col("m").alias("v"))).distinct(), state[0])
        state, last = _state(e), state
        if state == last:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
