"""Duplicate clusters that are kept up to date: new places meet the stored ones, and only what rests on a change is decided again.

Places with the same name tokens at the same point are one spot, which stands where its first place stands in rank
order. A spot leads unless an earlier spot within reach that is like it leads; else the earliest of those is its leader.
The state has one row a spot. What is decided again are new spots, spots that a new place moved forward, and later
neighbours of spots that began or ceased to lead - chains below a change, not the neighbourhood. Neighbours are found by
Spark in waves, one for each time that a change reaches spots which were not looked at; decisions between waves follow
rank order on the driver, over at most FEW pairs. A larger increment is clustered as a whole.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.text import name_tokens
from waymark.runtime import frozen

from .matching import cluster_duplicates, near_pairs

#: Pairs of neighbours that an increment may have to be decided on the driver.
FEW = 200_000
#: Columns of a spot: its first place, where that stands, and what was decided.
PLACE = ["id", "name", "latitude", "longitude", "rank"]


def spot_of(id_: Column, name: Column, latitude: Column, longitude: Column) -> Column:
    """The spot that a place belongs to; one whose name has no tokens is like no other, so it is a spot of its own."""
    tokens = name_tokens(name)
    here = F.concat_ws(",", F.array_join(F.array_sort(tokens), " "), latitude.cast("string"), longitude.cast("string"))
    return F.when(F.size(tokens) > 0, F.concat(F.lit("at:"), here)).otherwise(F.concat(F.lit("id:"), id_.cast("string")))


def spots_of(places: DataFrame) -> DataFrame:
    """(spot, id, name, latitude, longitude, rank) of the first place of each spot. ``places``: PLACE; rank is unique, of any type that sorts."""
    spot = spot_of(F.col("id"), F.col("name"), F.col("latitude"), F.col("longitude"))
    first = F.min_by(F.struct(*PLACE), "rank").alias("p")
    return places.select(spot.alias("spot"), *PLACE).groupBy("spot").agg(first).select("spot", "p.*")


def no_spots(spark: SparkSession, places: DataFrame) -> DataFrame:
    """An empty state for places of this schema."""
    kinds = {f.name: f.dataType.simpleString() for f in places.schema}
    columns = [f"{c} {kinds[c]}" for c in PLACE]
    return spark.createDataFrame([], ", ".join(["spot string", *columns, "leads boolean", f"leader_id {kinds['id']}", f"leader_rank {kinds['rank']}"]))


def _whole(spots: DataFrame, radius_m: float, least: float) -> DataFrame:
    """All spots (spot, PLACE), clustered."""
    by = cluster_duplicates(spots.select(F.col("spot").alias("id"), "name", "latitude", "longitude", "rank"), radius_m, least)
    heads = spots.select(F.col("spot").alias("leader_spot"), F.col("id").alias("leader_id"))
    led = by.select(F.col("id").alias("spot"), F.col("leader_id").alias("leader_spot"), "leader_rank").join(heads, "leader_spot")
    return spots.join(led, "spot").select("spot", *PLACE, (F.col("rank") == F.col("leader_rank")).alias("leads"), "leader_id", "leader_rank")


def reclustered(spots: DataFrame, places: DataFrame, radius_m: float = 150.0, least: float = 0.8, few: int = FEW) -> DataFrame:
    """Spots (spot, PLACE, leads, leader_id, leader_rank) that are to be written over those of ``spots``, the state, once ``places``
    come in. Places that are there already change nothing. With an empty state this is clustering from the start."""
    stored = spots.select("spot", F.col("rank").alias("old_rank"), F.col("leads").alias("old_leads"))
    came = spots_of(places).join(stored, "spot", "left").filter(F.col("old_rank").isNull() | (F.col("rank") < F.col("old_rank")))
    new = frozen(came.select("spot", *PLACE, F.coalesce("old_leads", F.lit(False)).alias("leads")))
    base = spots.select("spot", *PLACE, "leads").join(new.select("spot"), "spot", "left_anti").unionByName(new)
    everything = lambda: _whole(frozen(base.drop("leads")), radius_m, least)
    if spots.isEmpty() or len(first := new.limit(few + 1).collect()) > few:
        return everything()
    place = {r["spot"]: tuple(r[c] for c in PLACE) for r in first}
    rank = {spot: p[-1] for spot, p in place.items()}
    leads = {r["spot"]: r["leads"] for r in first}
    moved, near, lead, pairs = set(place), {}, {}, 0
    heap = [(r, spot) for spot, r in rank.items()]
    heapq.heapify(heap)
    todo = set(place)
    while heap:
        if heap[0][1] in todo and heap[0][1] not in near:
            # The neighbours of all spots that are to be decided and were not looked at: names and points never change.
            fresh = [s for s in todo if s not in near]
            left = base.sparkSession.createDataFrame([(s, *place[s][1:4]) for s in fresh], "id string, name string, latitude double, longitude double")
            right = base.select(F.col("spot").alias("id"), F.col("id").alias("place"), "name", "latitude", "longitude", "rank", "leads")
            found = near_pairs(left, right, radius_m, least).filter("id <> r_id").select("id", "r_id", "r_place", "r_name", "r_latitude", "r_longitude", "r_rank", "r_leads").limit(few + 1 - pairs).collect()
            pairs += len(found)
            if pairs > few:
                return everything()
            near.update((s, []) for s in fresh)
            for s, other, *of, led in found:
                near[s].append(other)
                place.setdefault(other, tuple(of))
                rank.setdefault(other, of[-1])
                leads.setdefault(other, led)
        _, spot = heapq.heappop(heap)
        if spot not in todo:
            continue
        todo.discard(spot)
        # Whatever stands earlier is decided: the heap gives the earliest first, and changes go to later ones alone.
        over = min(((rank[n], n) for n in near[spot] if rank[n] < rank[spot] and leads[n]), default=None)
        was, leads[spot] = leads[spot], over is None
        lead[spot] = over[1] if over else spot
        if leads[spot] != was or spot in moved and leads[spot]:
            for n in near[spot]:
                if rank[n] > rank[spot] and n not in todo:
                    todo.add(n)
                    heapq.heappush(heap, (rank[n], n))
    out = [(s, *place[s], leads[s], place[by][0], rank[by]) for s, by in lead.items()]
    return base.sparkSession.createDataFrame(out, spots.schema)
