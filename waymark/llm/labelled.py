"""Labelled rows for the classifiers: which rows are held out, and a bounded sample of the others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import frozen, text_of


def held_out(id_col: str = "doc_id") -> Column:
    """One row in five is never trained on: crc32 of the id's text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels and weights of at most ``per_class`` rows of each class that are not held out.

    Rows are chosen by a hash of their id. Texts of more than ``longest`` characters, or without any, are not used for
    training. Ids whose labels differ are not used either; of rows that share an id one text is. So at most
    2 * per_class * longest characters come to the driver, whatever is repeated. Weights bring the classes back to their
    shares among all labelled ids that are not held out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").select("doc_id", "y")
    shares = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id", F.lit(17))
    chosen = frozen(known.filter("y = 0").orderBy(order).limit(per_class).union(known.filter("y = 1").orderBy(order).limit(per_class)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).filter(F.length("text").between(1, longest))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    table = rows.toArrow().sort_by([("doc_id", "ascending")])
    y = table.column("y").to_numpy().astype(np.float64)
    weight = np.zeros(len(y))
    for c in (0, 1):
        if n := int((y == c).sum()):
            weight[y == c] = shares[c] / n
    return table.column("text").to_pylist(), y, weight / weight.mean() if len(y) else weight
