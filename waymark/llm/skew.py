"""Joins that stay even when one key holds much of the table, and bitmaps that keep texts out of shuffles.

Everything broadcast here is bounded by a constant: at most HEAVY rows of a narrow table, or MOST_BITS / 64 words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least this share (one in HEAVY) of the rows is heavy; at most HEAVY keys are.
HEAVY = 2000
#: Bits per id of a bitmap, and of the whole at most; beyond it a bitmap clears fewer rows and results stay the same.
BITS_AN_ID, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27


def heavy(table: DataFrame, count: str, total: int) -> DataFrame:
    """The rows of ``table`` (one a key) whose ``count`` is at least total / HEAVY. As counts add up to ``total`` at most, these are HEAVY rows at most."""
    return table.filter(F.col(count) * HEAVY >= total)


def skew_join(rows: DataFrame, table: DataFrame, on: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with a narrow ``table`` that has one row a key and in ``count`` the number of ``rows`` with it.

    Heavy keys are broadcast, so their rows are joined where they are; the others meet by a shuffle. ``total``: the number
    of ``rows``, or a bound of it.
    """
    given, added = rows.columns, [c for c in table.columns if c not in on]
    few = F.broadcast(heavy(table, count, total))
    many = table.filter(F.col(count) * HEAVY < total)
    met = rows.join(few, on, "left")
    rest = met.filter(F.col(count).isNull()).select(*given)
    return met.filter(F.col(count).isNotNull()).select(*given, *added).unionByName(rest.join(many, on).select(*given, *added))


def salted(pairs: DataFrame, texts: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (a, b) and ``texts`` (b, ...) with a column ``salt`` to join by besides ``b``, for rows too wide to broadcast.

    The pairs of a heavy ``b`` are dealt over as many salts as it is times heavy, and its row of ``texts`` is repeated for
    each: at most 2 * HEAVY rows more, whatever the size.
    """
    counts = heavy(pairs.groupBy("b").agg(F.count("*").alias("n")), "n", total)
    salts = F.broadcast(counts.select("b", F.ceil(F.col("n") * HEAVY / total).cast("int").alias("salts")))
    dealt = pairs.join(salts, "b", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    spread = texts.join(salts, "b", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return dealt, spread


class Bitmap:
    """A table of bits, set for the hashes of the ids of ``ids`` (doc_id), in size after their number ``n``.

    ``marked`` adds to a table with a column doc_id a column that is false only where the id is surely not among them. A
    null is an id like others.
    """

    def __init__(self, ids: DataFrame, n: int, seed: int = 0):
        bits = LEAST_BITS
        while bits < min(n * BITS_AN_ID, MOST_BITS):
            bits *= 2
        self.place = f"pmod(xxhash64(doc_id, {seed}), {bits})"
        word, bit = F.expr(f"cast(floor({self.place} / 64) as int)"), F.expr(f"shiftleft(1L, cast({self.place} % 64 as int))")
        self.words = F.broadcast(ids.select(word.alias("word"), bit.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")))

    def marked(self, rows: DataFrame, name: str) -> DataFrame:
        """An outer join with the words, which the optimiser does not move: a semi-join would be pushed below and shuffle whole rows."""
        rows = rows.withColumn("word", F.expr(f"cast(floor({self.place} / 64) as int)"))
        hit = F.expr(f"coalesce(getbit(bits, cast({self.place} % 64 as int)) = 1, false)")
        return rows.join(self.words, "word", "left").withColumn(name, hit).drop("word", "bits")


def texts_for(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, text) of the documents in ``ids`` (doc_id, distinct, ``n`` of them): the bitmap first, then an exact join."""
    return Bitmap(ids, n).marked(docs.select("doc_id", "text"), "hit").filter("hit").select("doc_id", "text").join(ids.select("doc_id"), "doc_id")


def without(docs: DataFrame, ids: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (doc_id, distinct, not null, ``n`` of them). Rows that the bitmap clears are kept where they are
    read; only the others are shuffled for the exact comparison."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")
    marked = Bitmap(ids, n).marked(docs.select(whole, F.col(id_col).cast("long").alias("doc_id")), "hit")
    found = ids.select("doc_id", F.lit(True).alias("found"))
    return marked.filter("not hit").select("r.*").union(marked.filter("hit").join(found, "doc_id", "left").filter("found is null").select("r.*"))
