"""Matching places by name and distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.numbers import haversine_m
from waymark.functions.text import jaccard, name_tokens
from waymark.runtime import frozen


@dataclass(frozen=True)
class Match:
    tolerance_m: float = 1200.0
    high: tuple[float, float] = (0.6, 300.0)
    medium: tuple[float, float] = (0.4, 800.0)
    reject_below: float = 0.45


def classify(score: Column, distance: Column, m: Match = Match()) -> Column:
    """struct(confidence, status) of a candidate by its name score and distance in metres."""
    row = lambda c, s: F.struct(F.lit(c).alias("confidence"), F.lit(s).alias("status"))
    return (
        F.when(distance.isNull(), row("low", "no_match"))
        .when(distance > m.tolerance_m, row("low", "geo_mismatch"))
        .when((score >= m.high[0]) & (distance <= m.high[1]), row("high", "ok"))
        .when((score >= m.medium[0]) & (distance <= m.medium[1]), row("medium", "ok"))
        .when(score < m.reject_below, row("low", "geo_mismatch"))
        .otherwise(row("low", "ok"))
    )


def misplaced(score: Column, distance: Column, far_m: float = 1200.0, least: float = 0.45) -> Column:
    """Both too far and too unlike."""
    return F.coalesce((distance > far_m) & (score < least), F.lit(False))


def vendor_mismatch(name: Column, vendor: Column, least: float = 0.2) -> Column:
    """The vendor page names somebody else; a page without a name is given the benefit of the doubt."""
    return (F.coalesce(vendor, F.lit("")) != "") & (jaccard(name_tokens(name), name_tokens(vendor)) < least)


def bounding_box(df: DataFrame, pad: float = 0.004) -> DataFrame:
    """(south, west, north, east) of latitude and longitude, padded by degrees."""
    return df.agg((F.min("latitude") - pad).alias("south"), (F.min("longitude") - pad).alias("west"), (F.max("latitude") + pad).alias("north"), (F.max("longitude") + pad).alias("east"))


def _row(lat: Column, step: float) -> Column:
    return F.floor(lat / step).cast("long")


def _column(lng: Column, row: Column, step: float) -> Column:
    """Cell of a longitude in a row of cells, as wide as the radius at the row's end nearer a pole."""
    edge = F.least(F.lit(89.0), (F.abs(row) + 1) * step)
    return F.floor(lng * F.cos(F.radians(edge)) / step).cast("long")


def cells(df: DataFrame, radius_m: float) -> DataFrame:
    """Adds the grid cell (cell_row, cell_col) of latitude and longitude. Two points within the radius are at most one row
    and one column apart (not across the 180th meridian)."""
    step = radius_m / 111_000.0
    return df.withColumn("cell_row", _row(F.col("latitude"), step)).withColumn("cell_col", _column(F.col("longitude"), F.col("cell_row"), step))


def cells_around(df: DataFrame, radius_m: float) -> DataFrame:
    """Nine rows for each row: its cell and those around it."""
    step = radius_m / 111_000.0
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    out = df.withColumn("_r", F.explode(near)).withColumn("cell_row", _row(F.col("latitude"), step) + F.col("_r"))
    return out.withColumn("_c", F.explode(near)).withColumn("cell_col", _column(F.col("longitude"), F.col("cell_row"), step) + F.col("_c")).drop("_r", "_c")


#: A token with at least one in so many of all tokens is frequent; at most so many are.
FREQUENT = 2000


def frequent_tokens(*tables: DataFrame) -> DataFrame:
    """One row with a map ``often``: how often each frequent token occurs in the names; at most FREQUENT entries."""
    all_tokens = None
    for df in tables:
        more = df.select(F.explode(name_tokens(F.col("name"))).alias("token"))
        all_tokens = more if all_tokens is None else all_tokens.unionByName(more)
    counts = all_tokens.groupBy("token").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    often = counts.join(F.broadcast(total), F.col("n") * FREQUENT >= F.col("total"))
    return often.agg(F.coalesce(F.map_from_entries(F.collect_list(F.struct("token", "n"))), F.create_map().cast("map<string,bigint>")).alias("often"))


def prefix_tokens(tokens: Column, often: Column, least: float) -> Column:
    """The tokens among which two names that score at least ``least`` share one: all but ceil(least * n) - 1 of n, in one
    order for all names. Frequent tokens come last, the most frequent at the end, so that joins meet on rare ones."""
    n = F.size(tokens)
    ordered = F.array_sort(F.transform(tokens, lambda t: F.struct(F.coalesce(F.try_element_at(often, t), F.lit(0).cast("long")).alias("n"), t.alias("t"))))
    return F.transform(F.slice(ordered, 1, F.greatest(F.lit(0), n - F.ceil(n * least - 1e-9).cast("int") + 1)), lambda x: x["t"])


def near_pairs(left: DataFrame, right: DataFrame, radius_m: float, least: float) -> DataFrame:
    """Pairs within the radius whose names score at least ``least`` (above 0): an equi-join on grid cell and token, never a
    product. A pair is kept at one common prefix token, so it comes once.

    Both sides have (id, name, latitude, longitude); columns of the right one come back with an r_ before them.
    """
    if least <= 0:
        raise ValueError("names that share nothing cannot be found by what they share")
    often = frozen(frequent_tokens(left, right)).scalar()
    with_prefix = lambda df: df.withColumn("tokens", name_tokens(F.col("name"))).withColumn("often", often).withColumn("prefix", prefix_tokens(F.col("tokens"), F.col("often"), least)).drop("often")
    l = cells_around(with_prefix(left), radius_m).withColumn("token", F.explode("prefix"))
    r = cells(with_prefix(right), radius_m).withColumn("token", F.explode("prefix"))
    keys = ["cell_row", "cell_col", "token"]
    r = r.select(*keys, *[F.col(c).alias(f"r_{c}") for c in r.columns if c not in keys])
    distance = haversine_m(F.col("latitude"), F.col("longitude"), F.col("r_latitude"), F.col("r_longitude"))
    pairs = l.join(r, keys).filter(F.col("token") == F.array_min(F.array_intersect("prefix", "r_prefix")))
    pairs = pairs.withColumn("score", jaccard(F.col("tokens"), F.col("r_tokens"))).filter(F.col("score") >= least)
    return pairs.withColumn("distance", distance).filter(F.col("distance") <= radius_m).drop(*keys, "tokens", "r_tokens", "prefix", "r_prefix")


def best_match(left: DataFrame, pool: DataFrame, radius_m: float = 220.0, least: float = 0.34, pull: float = 0.25) -> DataFrame:
    """For each left row the pool row with the largest score - pull * distance / radius; the first by r_pos of several.
    Rows without a match are left out. ``pool`` has a position column ``pos`` besides the columns of near_pairs. The best
    is found by one aggregation."""
    pairs = near_pairs(left, pool, radius_m, least).withColumn("rank_score", F.col("score") - F.col("distance") / radius_m * pull)
    whole = F.struct(*[F.col(c) for c in pairs.columns])
    return pairs.groupBy(F.col("id").alias("_id")).agg(F.max_by(whole, F.struct("rank_score", -F.col("r_pos"))).alias("_row")).select("_row.*")


#: Open edges that one task decides, some tens of bytes each.
FEW_EDGES = 200_000


def _covered(edges: DataFrame) -> DataFrame:
    """(rank) of the nodes that do not lead, of a graph (later, earlier) with at most FEW_EDGES edges, all of whose nodes are open."""
    kind = edges.schema["later"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier: dict = {}
        ranks: dict = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # A rank of several parts comes as a dict; its values sort as the rank does.
                key, other = (tuple(a.values()), tuple(b.values())) if isinstance(a, dict) else (a, b)
                ranks[key] = a
                earlier.setdefault(key, []).append(other)
            of = batch.schema.field(0).type
        covered: set = set()
        for node in sorted(earlier):
            if any(e not in covered for e in earlier[node]):
                covered.add(node)
        if covered:
            yield pa.RecordBatch.from_arrays([pa.array([ranks[c] for c in covered], of)], ["rank"])

    return edges.select("later", "earlier").coalesce(1).mapInArrow(run, f"rank {kind}")


def cluster_duplicates(places: DataFrame, radius_m: float = 150.0, least: float = 0.8) -> DataFrame:
    """(id, rank, leader_id, leader_rank): each place joins the earliest leader that it matches, or leads itself.

    ``places``: id, name, latitude, longitude, rank (unique). A place leads if it matches no earlier leader, so the
    leaders are the first maximal independent set in rank order. Rows with the same tokens at the same point stand or fall
    together, so only the first of them enters the graph. Rounds decide every place whose earlier neighbours are decided, until
    at most FEW_EDGES edges are open; what those decide is one task's work, in rank order.
    """
    whole = places.select("id", "name", "latitude", "longitude", "rank").withColumn("spot", F.struct(F.array_sort(name_tokens(F.col("name"))).alias("t"), "latitude", "longitude"))
    heads = frozen(whole.filter(F.size("spot.t") > 0).groupBy("spot").agg(F.min_by(F.struct("id", "name"), "rank").alias("h"), F.min("rank").alias("rank")))
    node = heads.select(F.col("h.id").alias("id"), F.col("h.name").alias("name"), "spot.latitude", "spot.longitude", "rank")
    edges = frozen(near_pairs(node, node, radius_m, least).filter("r_rank < rank").select(F.col("rank").alias("later"), F.col("r_rank").alias("earlier")))
    open_ = frozen(node.select("rank"))
    leaders = open_.limit(0)
    live = edges
    while live.limit(FEW_EDGES + 1).count() > FEW_EDGES:
        blocked = live.select(F.col("later").alias("rank")).distinct()
        new = frozen(open_.join(blocked, "rank", "left_anti"))
        leaders = frozen(leaders.union(new))
        covered = live.join(new.withColumnRenamed("rank", "earlier"), "earlier").select(F.col("later").alias("rank")).distinct()
        open_ = frozen(open_.join(new, "rank", "left_anti").join(covered, "rank", "left_anti"))
        live = frozen(live.join(open_.withColumnRenamed("rank", "later"), "later").join(open_.withColumnRenamed("rank", "earlier"), "earlier", "left_semi"))
    leaders = frozen(leaders.union(open_.join(_covered(live), "rank", "left_anti")))
    under = edges.join(leaders.withColumnRenamed("rank", "earlier"), "earlier").groupBy(F.col("later").alias("rank")).agg(F.min("earlier").alias("leader_rank"))
    of_head = heads.select("spot", "rank").join(under, "rank", "left").join(leaders.withColumn("leads", F.lit(True)), "rank", "left")
    of_head = of_head.select("spot", F.when(F.col("leads"), F.col("rank")).otherwise(F.col("leader_rank")).alias("leader_rank"))
    # A name without tokens matches nothing, not even itself.
    placed = whole.join(of_head, "spot", "left").select("id", "rank", F.coalesce("leader_rank", "rank").alias("leader_rank"))
    names = whole.select(F.col("rank").alias("leader_rank"), F.col("id").alias("leader_id"))
    return placed.join(names, "leader_rank").select("id", "rank", "leader_id", "leader_rank")


def propagate(records: DataFrame, clusters: DataFrame, fields: list[str]) -> DataFrame:
    """Every place with its leader's fields; ``duplicate_of`` names the leader of an alias (id and record id)."""
    lead = records.select(F.col("id").alias("leader_id"), F.col("record_id").alias("leader_record"), *fields)
    own = records.select("id", "record_id")
    alias = F.col("leader_id") != F.col("id")
    return (
        clusters.select("id", "leader_id")
        .join(own, "id")
        .join(lead, "leader_id", "left")
        .select("id", "record_id", F.when(alias, F.col("leader_id")).alias("duplicate_of"), F.when(alias, F.col("leader_record")).alias("duplicate_of_record"), *fields)
    )
