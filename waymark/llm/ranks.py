"""Exact values at given ranks of all values, found by counting: no sort, no task and no driver that holds them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that a range of values is counted in; the driver gets so many counts a range.
PARTS = 512


def at_ranks(values: DataFrame, wanted: Callable[[str, int], Iterable[int]]) -> dict[str, tuple[int, dict[int, float]]]:
    """For every name in ``values`` (name string, x double; best stored, as it is read a few times) how many values it has, and
    its values at the ranks (from 0, ascending) that ``wanted`` asks for by name and number.

    Values between the least and the largest are counted in parts of equal width, the part with the rank is the next
    range, and so on until a part's least value is its largest.
    """
    found: dict[str, tuple[int, dict[int, float]]] = {}
    ranges: dict[tuple[str, float, float], list[tuple[int, int]]] = {}  # range: ranks, each with its rank within the range
    for name, n, lo, hi in values.groupBy("name").agg(F.count("x"), F.min("x"), F.max("x")).collect():
        found[name] = n, {}
        ranges[name, lo, hi] = [(rank, rank) for rank in set(wanted(name, n)) if 0 <= rank < n]
    while True:
        for (name, lo, hi), ranks in ranges.items():
            if lo == hi:
                found[name][1].update((rank, lo) for rank, _ in ranks)
        ranges = {key: ranks for key, ranks in ranges.items() if key[1] < key[2] and ranks}
        if not ranges:
            return found
        keys = list(ranges)
        asked = values.sparkSession.createDataFrame([(i, *key) for i, key in enumerate(keys)], "i int, name string, lo double, hi double")
        inside = values.join(F.broadcast(asked), "name").filter("x between lo and hi")
        part = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS)
        counts = inside.groupBy("i", part.alias("part")).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        before, following = [0] * len(keys), {}
        for r in sorted(counts.collect(), key=lambda r: (r.i, r.part)):
            name = keys[r.i][0]
            for rank, place in ranges[keys[r.i]]:
                if before[r.i] <= place < before[r.i] + r.n:
                    following.setdefault((name, r.lo, r.hi), []).append((rank, place - before[r.i]))
            before[r.i] += r.n
        ranges = following
