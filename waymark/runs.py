"""A run from a seed table to stored records: scope, duplicates, records, work queue, captured pages, store, outputs.

The store is three versioned tables in one folder: ``records`` (one row a seed place), ``spots`` (the state of duplicate
clusters) and ``members`` (the spot of each place). A run reads them, adds what the seed has new, takes the captured
payloads of places that are still to be done, and writes only buckets in which records changed. A run that is given again
under its number after a failure finds its own work done and changes nothing more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import clusters, records
from .operators.scope import Scope, scope_reason, split_by_reason
from .runtime import frozen
from .sources.snapshots import Snapshots
from .streaming.guard import KEPT_DAYS


@dataclass(frozen=True)
class Settings:
    """What a run depends on. ``harvest``: fields that a finished visit has; others are taken again until ``attempts``."""

    scope: Scope = field(default_factory=Scope)
    location: str = "Gulshan"
    prefix: str = "GUL"
    radius_m: float = 150.0
    least: float = 0.8
    attempts: int = 3
    limit: int | None = None
    harvest: tuple[str, ...] = ("rating", "review_count", "reviews", "hours")


#: Columns that every record has besides the payload's fields.
OWN = {
    "cafe_id": "string",
    "pos": "long",
    "match_confidence": "string",
    "last_attempt": "string",
    "last_updated": "string",
    "duplicate_of": "string",
    "leader_code": "string",
}
#: Columns that a record does not share with its duplicates.
IDENTITY = ("place_code", "cafe_id", "pos", "name", "area", "seed_address", "duplicate_of", "leader_code", "run_at")
#: Columns of captured payloads that are no fields.
OF_VISIT = ("place_code", "confidence", "status", "fetched_at")


def there(rows: DataFrame, c: str) -> Column:
    """Whether a record has something in a field: not null, '', 0 or without elements; a field that the table lacks is never there."""
    if c not in rows.columns:
        return F.lit(False)
    kind = rows.schema[c].dataType.typeName()
    some = F.size(c) > 0 if kind in ("array", "map") else F.col(c) != "" if kind == "string" else F.col(c) if kind == "boolean" else F.col(c) != 0
    return F.coalesce(some, F.lit(False))


class Run:
    """Runs over the store in one folder."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings = Settings(), buckets: int = 16):
        self.spark, self.settings = spark, settings
        self.records = Snapshots(spark, f"{path}/records", "place_code", buckets)
        self.spots = Snapshots(spark, f"{path}/spots", "spot", buckets)
        self.members = Snapshots(spark, f"{path}/members", "place_code", buckets)

    # The steps --------------------------------------------------------------------------------------------------

    def _stored(self, fields: DataFrame) -> DataFrame | None:
        """The stored records, with columns of ``fields`` that they do not have yet."""
        if not self.records.versions():
            return None
        old = self.records.read()
        return old.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields.schema if f.name not in old.columns])

    def _leaders(self, kept: DataFrame, number: int) -> DataFrame:
        """(place_code, leader_code) of places in scope; the state of clusters takes in those that are new."""
        rank = F.struct(F.coalesce("popularity", F.lit(0.0)).alias("popularity"), F.col("pos"), F.col("place_code").alias("code"))
        places = kept.select(F.col("place_code").alias("id"), F.col("business_name").alias("name"), "latitude", "longitude", rank.alias("rank"))
        known = self.members.read().select(F.col("place_code").alias("id")) if self.members.versions() else None
        new = frozen(places.join(known, "id", "left_anti") if known is not None else places)
        state = self.spots.read() if self.spots.versions() else clusters.no_spots(self.spark, places)
        self.spots.upsert(clusters.reclustered(state, new, self.settings.radius_m, self.settings.least), stream="runs", batch=number)
        spot = clusters.spot_of(F.col("id"), F.col("name"), F.col("latitude"), F.col("longitude"))
        self.members.upsert(new.select(F.col("id").alias("place_code"), spot.alias("spot")), stream="runs", batch=number)
        led = self.spots.read().select("spot", F.col("leader_id").alias("leader_code"))
        return self.members.read().join(led, "spot").select("place_code", "leader_code")

    def _materialised(self, kept: DataFrame, excluded: DataFrame, payloads: DataFrame, number: int) -> DataFrame:
        """A record for every seed row: the stored one, or a new one that waits or is out of scope; ids follow the largest."""
        all_rows = kept.unionByName(excluded.drop("reason"))
        fields = payloads.drop(*OF_VISIT)
        stored = self._stored(fields)
        new = all_rows if stored is None else all_rows.join(stored.select("place_code"), "place_code", "left_anti")
        out = excluded.select("place_code", F.lit(True).alias("_out"))
        made = records.from_seed(new).join(out, "place_code", "left").withColumn("scrape_status", F.when(F.col("_out"), "out_of_scope").otherwise(F.col("scrape_status"))).drop("_out")
        made = made.join(new.select("place_code", "pos"), "place_code")
        blank = [F.lit(None).cast(kind).alias(c) for c, kind in OWN.items() if c not in ("cafe_id", "pos")]
        have = set(made.columns)
        made = made.select("*", *blank, *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields.schema if f.name not in have])
        known = stored.select("place_code", "cafe_id") if stored is not None else made.limit(0).select("place_code", F.lit("").alias("cafe_id"))
        ids = records.assign_ids(new.select("place_code", "pos"), known, self.settings.prefix)
        made = made.join(ids, "place_code")
        everything = made if stored is None else stored.unionByName(made, allowMissingColumns=True)
        leaders = self._leaders(kept, number)
        heads = everything.select(F.col("place_code").alias("leader_code"), F.col("cafe_id").alias("_head"))
        led = leaders.join(heads, "leader_code")
        joined = everything.drop("leader_code", "duplicate_of").join(led, "place_code", "left")
        alias = F.when(F.col("leader_code") != F.col("place_code"), F.col("_head"))
        return joined.withColumn("duplicate_of", alias).drop("_head")

    def harvested(self, rows: DataFrame) -> Column:
        """Whether a record has all that a finished visit has."""
        return F.forall(F.array(F.lit(True), *[there(rows, c) for c in self.settings.harvest]), lambda x: x)

    def _todo(self, rows: DataFrame) -> DataFrame:
        """Leaders whose turn it is, in order of ``pos``."""
        leaders = rows.filter("leader_code = place_code")
        state = leaders.select("place_code", "scrape_status", "attempts", self.harvested(rows).alias("complete"))
        return records.pending(leaders.select("place_code", "pos"), state, self.settings.attempts, self.settings.limit)

    def _shared(self, rows: DataFrame) -> DataFrame:
        """Records of duplicates that no visit has reached yet have what was found for their leader in an earlier run."""
        found = [c for c in rows.columns if c not in IDENTITY]
        lead = rows.filter("leader_code = place_code and scrape_status <> 'pending'").select("leader_code", F.struct(*found).alias("_lead"))
        joined = rows.join(lead, "leader_code", "left")
        late = F.col("_lead").isNotNull() & (F.col("leader_code") != F.col("place_code")) & (F.col("scrape_status") == "pending")
        return joined.select(*[F.when(late, F.col(f"_lead.{c}")).otherwise(F.col(c)).alias(c) if c in found else F.col(c) for c in rows.columns])

    def _write(self, rows: DataFrame, number: int, stamp: str) -> int:
        """Records that differ from the stored ones, folded in once for this run."""
        rows = rows.withColumn("run_at", F.lit(stamp))
        old = self._stored(rows)
        if old is None:
            return self.records.upsert(rows, stream="runs", batch=number)
        same = F.array(*[F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in rows.columns if c != "run_at"])
        kept = old.alias("o").join(rows.alias("n"), "place_code").filter(F.forall(same, lambda x: x)).select("place_code")
        return self.records.upsert(rows.join(kept, "place_code", "left_anti"), stream="runs", batch=number)

    # What a user calls ------------------------------------------------------------------------------------------

    def take(self, seed: DataFrame, captured: DataFrame, number: int, stamp: str) -> int:
        """Run ``number`` (runs count up): the version of the records it leads to.

        ``seed``: place_code, business_name, latitude, longitude, address, area, sub_area, sub_type, popularity, pos; codes are
        unique. ``captured``: one row of a place's visit, OF_VISIT and any fields; only those of places whose turn it is count,
        and their duplicates share them. ``stamp`` is the time of the run.
        """
        kept, excluded = split_by_reason(seed, scope_reason(self.settings.scope))
        rows = frozen(self._materialised(kept, excluded, captured, number))
        visits = captured.join(self._todo(rows).select("place_code"), "place_code", "left_semi").withColumnRenamed("place_code", "leader_code")
        shared = rows.select("place_code", "leader_code").join(visits, "leader_code").drop("leader_code")
        return self._write(self._shared(records.refresh(rows, shared)), number, stamp)

    def fold_in(self, seed: DataFrame, older: DataFrame, number: int, stamp: str) -> int:
        """Payloads of earlier runs (place_code, fetched_at and fields) fill records that no visit of ours has filled; they are no attempts."""
        kept, excluded = split_by_reason(seed, scope_reason(self.settings.scope))
        payloads = older.select("*", F.lit("medium").alias("confidence"), F.lit("legacy").alias("status"))
        rows = frozen(self._materialised(kept, excluded, payloads, number))
        open_ = rows.filter("leader_code is not null and scrape_status <> 'ok'").select("place_code", "leader_code", "attempts")
        shared = open_.drop("attempts").join(payloads.withColumnRenamed("place_code", "leader_code"), "leader_code").drop("leader_code")
        refreshed = records.refresh(rows, shared)
        before = rows.select("place_code", F.col("attempts").alias("_attempts"))
        return self._write(self._shared(refreshed.join(before, "place_code").withColumn("attempts", F.col("_attempts")).drop("_attempts")), number, stamp)

    def outputs(self, version: int | None = None) -> DataFrame:
        """Records of a version with why they are excluded and what they lack."""
        rows = self.records.read(version)
        missing = records.gaps(*[there(rows, c) for c in ("menu", "price", "rating", "reviews", "review_count", "hours")], F.col("scrape_status"))
        return rows.select("*", missing.alias("missing"), records.excluded_reason(F.col("scrape_status"), F.col("business_status"), F.col("duplicate_of")).alias("excluded_reason"))

    def summary(self, version: int | None = None) -> DataFrame:
        return records.summary(self.outputs(version))

    def forget(self, keep: int = KEPT_DAYS) -> None:
        """Delete versions but the newest."""
        for store in (self.records, self.spots, self.members):
            store.vacuum(keep)
