"""Exact de-duplication with a heavy-hitter split; DataFrame operations only.

Digests of normalised texts are computed once. Spark's frequent-item aggregate (the Misra-Gries counter summary: at
most 1/support counters a task, merged) names every digest that may fill ``support`` of all rows. A second pass
counts those candidates exactly and finds their winners; this verified table has at most 1/support rows and is
broadcast, so rows of heavy digests are settled where they are read and never shuffled. All other groups are smaller
than ``support`` of the table and go through an ordinary shuffle on the digest.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .cluster import frozen, text_of
from .skew import Bitmap

#: A digest with at least this share of all rows is heavy; at most 1 / SUPPORT digests are.
SUPPORT = 1 / 2000


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else changed."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def normalised(column: str = "text") -> Column:
    """The text with A-Z lower-cased and nothing else changed; null is empty."""
    return lowered(text_of(column))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, row) of every row, computed once; ``row`` tells rows with equal ids apart. A null text counts as "",
    a null id stays null; other columns are ignored; an empty table gives an empty one."""
    return frozen(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"), F.monotonically_increasing_id().alias("row")))


def exact_duplicates(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Decisions for a table made by ``keyed``: doc_id, keep_id, group_size, kept, text_sha256, and ``twins``, the
    number of rows that share both id and text with the row that stays. Null texts count as "" (see ``keyed``).

    Of rows with equal digests the one with the largest doc_id stays (a null id counts as smallest; of equal ids one
    row stays). Exactly one row of each group has ``kept``. An empty table gives an empty one.
    """
    best = F.max(F.struct("doc_id", "row")).alias("best")
    # As text: the aggregate's counters tell byte arrays apart by object, strings by value.
    candidates = rows.select(F.hex("digest").alias("d")).freqItems(["d"], support).select(F.explode(F.array_distinct("d_freqItems")).alias("d")).select(F.unhex("d").alias("digest"))
    heavy = frozen(
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), best)
        .filter(F.col("n") >= support * rows.count())
    )
    top = F.broadcast(heavy.select("digest", "n", "best"))
    # Rows of heavy digests that have the winner's id: their number is the group's ``twins``.
    same = rows.join(top, "digest").filter(F.col("doc_id").eqNullSafe(F.col("best.doc_id"))).groupBy("digest").agg(F.count("*").alias("twins"))
    settled = rows.join(F.broadcast(heavy.join(same, "digest")), "digest")
    whole = Window.partitionBy("digest")
    light = (
        rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        .withColumn("n", F.count("*").over(whole))
        .withColumn("best", F.max(F.struct("doc_id", "row")).over(whole))
        .withColumn("twins", F.count(F.when(F.col("doc_id").eqNullSafe(F.col("best.doc_id")), 1)).over(whole))
    )
    columns = ["doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "twins"]
    return settled.select(*columns).unionByName(light.select(*columns))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that exact de-duplication drops; all columns kept, whatever their names, one row of each equal text.

    A null id or text is one like others, the text as "" (see ``exact_duplicates``). Decisions are made on ids and digests;
    rows are kept or dropped where they are read: a bitmap of the ids of dropped rows clears most of the kept, a bitmap of
    kept ids among the rest clears the dropped. Only ids with rows of both sorts, and the few that a bitmap cannot tell, are
    compared exactly by id and digest. Where the row that stays has repeats with the same id and text, which nothing but
    their other columns tells apart, one of them is returned. An empty table gives an empty one.
    """
    decided = frozen(exact_duplicates(keyed(docs, id_col, text_col)).select("doc_id", "kept", F.unhex("text_sha256").alias("digest")))
    dropped = decided.filter("not kept").select("doc_id")
    first = Bitmap(dropped, dropped.count())
    rivals = frozen(first.marked(decided.filter("kept").select("doc_id", "digest"), "maybe").filter("maybe").drop("maybe"))
    second = Bitmap(rivals.select("doc_id"), rivals.count(), seed=1)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")
    rows = second.marked(first.marked(docs.select(whole, F.col(id_col).cast("long").alias("doc_id")), "maybe_dropped"), "maybe_kept")
    unclear = rows.filter("maybe_dropped and maybe_kept").select("r", "doc_id", F.unhex(F.sha2(normalised(f"r.`{text_col}`"), 256)).alias("digest"))
    one = unclear.groupBy("doc_id", "digest").agg(F.first("r").alias("r"))
    exact = one.join(rivals, one["doc_id"].eqNullSafe(rivals["doc_id"]) & (one["digest"] == rivals["digest"]), "left_semi")
    return rows.filter("not maybe_dropped").select("r.*").unionByName(exact.select("r.*"))
