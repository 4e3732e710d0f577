"""Whitening of embeddings: count, mean and centred scatter of all vectors merged pairwise, components on the driver.

Every partition takes its vectors batch by batch: a batch's mean and scatter around it are merged into the partition's
with Chan's formula, and partitions are merged the same way in a tree, so nothing is ever centred around a mean that is
far off, and what travels is one d x d matrix a partition. Sums of the entries are exact integers. The eigenvectors
are the driver's only work. A second pass over the whitened vectors, merged alike, tells how far their covariance is
from the identity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import frozen

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024.0, 100_000
#: Components that are returned, and how many merged partitions meet in one task of the tree.
MOST, FAN = 8, 8
#: Vectors that are held as doubles at once.
VALUES = 1 << 20
#: Entries beyond it are cut off at it, as a cast to long would; sums of as many as there may be stay exact.
FAR = float(1 << 61)


@dataclass
class Moments:
    """Count, exact sums, and scatter (sum of outer products) around the mean of some vectors."""

    n: int
    sums: np.ndarray  # of Python integers, or of doubles
    scatter: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of the rows of ``x``: whole numbers (int64), summed exactly, or doubles."""
        if x.dtype == np.int64 and len(x) and np.abs(x.astype(np.float64)).max() * len(x) >= 2.0**62:
            sums = x.astype(object).sum(axis=0)
        else:
            sums = x.sum(axis=0)
        sums = np.array(sums.tolist(), object if x.dtype == np.int64 else np.float64)
        centred = x.astype(np.float64) - (sums / len(x)).astype(np.float64)
        return Moments(len(x), sums, centred.T @ centred)

    @property
    def mean(self) -> np.ndarray:
        return (self.sums / self.n).astype(np.float64)

    def merged(self, other: Moments) -> Moments:
        """Chan, Golub and LeVeque: the scatter of both is the sum of theirs and of the means' distance, weighted."""
        apart, n = self.mean - other.mean, self.n + other.n
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + np.outer(apart, apart) * (self.n / n * other.n))


def _vectors(batch: pa.RecordBatch, column: str, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, doubles) of runs of rows; all vectors have ``dims`` entries."""
    vectors, step = batch.column(column), max(1, VALUES // max(1, dims))
    for lo in range(0, batch.num_rows, step):
        part = vectors[lo : lo + step]
        yield lo, part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), dims)


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) as int64; SHIFT is added where it matters, as it is the same for all."""
    return np.clip(np.floor(values * SCALE), -FAR, FAR).astype(np.int64)


def moments(rows: DataFrame, column: str, dims: int, exact: bool) -> Moments:
    """Moments of a column of arrays; there must be a row. Each partition gives one; the tree is as deep as keeps FAN of them
    to a task, and about as many for the driver."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, values in _vectors(batch, column, dims):
                if len(values):
                    own = Moments.of(whole(values) if exact else values)
                    total = own if total is None else total.merged(own)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"n": [total.n], "sums": [[str(s) if exact else float(s).hex() for s in total.sums]], "scatter": [total.scatter.tobytes()]})

    def read(r) -> Moments:
        sums = np.array([int(s) if exact else float.fromhex(s) for s in r["sums"]], object if exact else np.float64)
        return Moments(r["n"], sums, np.frombuffer(r["scatter"]).reshape(dims, dims))

    parts = rows.select(column).mapInArrow(local, "n long, sums array<string>, scatter binary").rdd.map(read)
    depth = max(2, math.ceil(math.log(max(2, parts.getNumPartitions()), FAN)))
    return parts.treeReduce(Moments.merged, depth)


@dataclass
class Whitening:
    """A fitted transform: vectors of ``dims`` entries to at most MOST components of variance one.

    ``values``: eigenvalues of the covariance, falling, and ``axes`` (columns) their unit vectors, the largest entry of each
    positive; ``spread``: the covariance's trace. Components whose eigenvalue is not above rounding are ``flat``: no direction to scale by.
    """

    fit: Moments
    values: np.ndarray
    axes: np.ndarray
    spread: float
    error: float | None = None

    @cached_property
    def flat(self) -> np.ndarray:
        return self.values <= max(len(self.fit.sums) * np.finfo(float).eps * float(self.values.max(initial=0.0)), 0.0)

    @property
    def explained(self) -> list[float | None]:
        return [float(v / self.spread) if self.spread > 0 else None for v in self.values]

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole numbers ``x`` (without SHIFT); 0 in flat components."""
        scale = np.where(self.flat, 0.0, 1 / np.sqrt(np.where(self.flat, 1.0, self.values)))
        return (x - self.fit.mean) @ self.axes * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2 of each row, exact; None where a long cannot hold it."""
        n, sums = self.fit.n, self.fit.sums
        near = ((x - self.fit.mean) ** 2).sum(axis=1) * float(n) ** 2
        # Below 2**62 every term's root is below 2**31, though n * x itself may not fit.
        out: list[int | None] = [None] * len(x)
        small = np.flatnonzero(near < 2.0**61)
        if len(small) and max(abs(int(s)) for s in sums.tolist()) < 1 << 62 and np.abs(x[small].astype(np.float64)).max() * n < 2.0**62:
            d = x[small] * n - sums.astype(np.int64)
            for i, v in zip(small.tolist(), (d * d).sum(axis=1).tolist(), strict=True):
                out[i] = v
            small = small[:0]
        for i in (*small.tolist(), *np.flatnonzero((near >= 2.0**61) & (near < 2.0**63.5)).tolist()):
            exact = sum((n * a - s) ** 2 for a, s in zip(x[i].tolist(), sums.tolist(), strict=True))
            out[i] = exact if exact < 1 << 63 else None
        return out


def finite(vector: Column) -> Column:
    """Whether a vector is one that is used: not null, and no entry null, NaN or infinite."""
    ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda c: ok(c.cast("double"))), F.lit(False))


def used(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that are used, and the number of entries that vectors have: where they differ, that of
    most rows (of equally many the larger), and the others are left out, as no covariance holds both."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(finite(F.col("vector")))
    most = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).head()
    dims = most["dims"] if most else 0
    return rows.filter(F.size("vector") == dims), dims


def fit(rows: DataFrame, dims: int) -> Whitening | None:
    """The transform for a table (vector) whose vectors all have ``dims`` entries; None without rows or entries."""
    if not dims:
        return None
    found = moments(rows, "vector", dims, exact=True)
    covariance = found.scatter / found.n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    best = np.argsort(-values, kind="stable")[:MOST]
    axes = axes[:, best]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(best))] < 0, -1.0, 1.0)
    return Whitening(found, np.maximum(values[best], 0.0), axes, float(np.trace(covariance)))


def transformed(rows: DataFrame, dims: int, by: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array<double>) of ``rows`` (vec_id, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, values in _vectors(batch, "vector", dims):
                x = whole(values)
                w = by.apply(x)
                flat = pa.array(w.ravel())
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id")[lo : lo + len(x)], pa.array(by.deviations(x), pa.int64()), pa.ListArray.from_arrays(ends, flat)], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "vector").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """(vec_id, deviation, whitened) of every row of ``table`` whose vector is used, and the transform with ``error``, the
    largest entry by which their covariance differs from the identity (flat components are left out of both).

    Each row is whitened on its own and repeats alike; a null id is kept. A table without usable vectors gives no rows and
    no transform. Memory: a few matrices of d x d doubles and VALUES entries a task. Entries beyond 2**61 / SCALE count as
    that. The whitened rows, at most MOST doubles each, are stored, so the pass that verifies them reads those.
    """
    rows, dims = used(table, id_col, vector_col)
    by = fit(rows, dims)
    if by is None:
        return table.sparkSession.createDataFrame([], "vec_id long, deviation long, whitened array<double>"), None
    out = frozen(transformed(rows, dims, by))
    found = moments(out, "whitened", len(by.values), exact=False)
    there = np.flatnonzero(~by.flat)
    error = np.abs(found.scatter / found.n - np.eye(len(by.values)))[np.ix_(there, there)].max(initial=0.0)
    return out, replace(by, error=float(error))


def components(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each row of ``whitened`` and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error. ``whitened`` is null in flat components, ``explained`` where vectors do not differ at all."""
    rows, by = whitened(table, id_col, vector_col)
    n, error = (by.fit.n, by.error) if by else (0, None)
    flat, explained = ([bool(f) for f in by.flat], by.explained) if by else ([], [])
    shares = F.array(*[F.lit(e).cast("double") for e in explained]).cast("array<double>")
    gone = F.array(*[F.lit(f) for f in flat]).cast("array<boolean>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(~F.get(gone, "at"), F.col("value")).alias("whitened"),
        F.get(shares, "at").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
