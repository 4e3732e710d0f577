"""A Merkle manifest of a dataset: one root that commits to every row, and for every row the siblings that prove it.

Rows become leaves, ordered within trees; every RUN consecutive nodes have one parent, up to a subroot a tree, and the
subroots, ordered by their trees' names, have a root above them the same way. Nodes are sorted once by a range
shuffle of their digests and numbered partition by partition. Aligned blocks of BLOCK nodes are then walked as
recursive functions in post-order, each in one group: a subtree's digest is returned, and its siblings are appended to
the leaves below while the recursion unwinds. The blocks' roots are the nodes of the next distributed walk, until each
tree has one. On the way down every block meets the proof of its own root, one row, and walks again to give its leaves
theirs. Texts are read once, to be digested; what is shuffled has some hundred bytes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import frozen

#: Children of a node, levels that one group walks, and the nodes it holds.
RUN, HEIGHT = 8, 3
BLOCK = RUN**HEIGHT
#: Characters of a digest.
HEX = 64
STEPS = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value that no other sequence of values can be read as: its UTF-8 length, a colon and itself; ``-`` where it is null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def height_of(block: int, nodes: int) -> int:
    """Levels above the nodes of a block. A block that is not full and the first of its tree is the whole tree."""
    if block or nodes == BLOCK:
        return HEIGHT
    return next(h for h in range(HEIGHT + 1) if RUN**h >= nodes)


def walk(nodes: list[str], height: int, proofs: list[list[tuple[str, str]]] | None = None) -> str:
    """The digest ``height`` levels above ``nodes``, in post-order. Where ``proofs`` is given, each leaf's list gets the siblings
    (before, after) of every node between it and that digest, lowest first."""

    def subtree(lo: int, height: int) -> str:
        if not height:
            return nodes[lo]
        step = RUN ** (height - 1)
        starts = range(lo, min(lo + RUN * step, len(nodes)), step)
        run = "".join([subtree(at, height - 1) for at in starts])
        if proofs is not None:
            for k, at in enumerate(starts):
                siblings = run[: HEX * k], run[HEX * (k + 1) :]
                for below in proofs[at : at + step]:
                    below.append(siblings)
        return hashlib.sha256(run.encode()).hexdigest()

    return subtree(0, height)


def _numbers(runs: Iterator[pa.Array], first: int) -> Iterator[np.ndarray]:
    """Places of values within their run of equal values, over consecutive arrays; the first run starts at ``first``."""
    last, count, begun = None, first, False
    for values in runs:
        n = len(values)
        if not n:
            yield np.zeros(0, np.int64)
            continue
        codes = values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(codes[1:] != codes[:-1]) + 1))
        at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        if not begun or values[0].as_py() == last:
            at[: starts[1] if len(starts) > 1 else n] += count
        yield at
        last, count, begun = values[-1].as_py(), int(at[-1]) + 1, True


def indexed(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, key, digest, ...) with ``idx``, their places from 0 within their tree by key, then digest (nulls first).

    A range shuffle sorts them all, so a tree of any share of the rows is spread. Each partition tells how many nodes its
    first and last tree have in it - one row a partition, which is all that comes to the driver - and from that it is known
    where the first tree of every partition goes on.
    """
    by = ["tree", "key", "digest", "_row"]
    # Stored first, as a range shuffle reads its input twice.
    ordered = frozen(frozen(nodes).withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("_row"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        heads = tails = rows = 0
        for batch in batches:
            values = batch.column(0)
            for n, value in zip(np.diff(np.append(at := _starts(values), len(values))).tolist(), [values[int(i)].as_py() for i in at], strict=True):
                name = b"" if value is None else hashlib.sha256(value.encode()).digest()
                if first is None:
                    first = name
                tails = tails + n if name == last else n
                heads += n if name == first else 0
                last, rows = name, rows + n
        if rows:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "first": [first], "last": [last], "heads": [heads], "tails": [tails], "rows": [rows]})

    told = ordered.select("tree").mapInArrow(ends, "part long, first binary, last binary, heads long, tails long, rows long")
    offsets, tree, count = {}, None, 0
    for r in sorted(told.collect()):
        offsets[r["part"]] = count if r["first"] == tree else 0
        count = (offsets[r["part"]] if r["heads"] == r["rows"] else 0) + r["tails"]
        tree = r["last"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def trees() -> Iterator[pa.Array]:
            for batch in batches:
                held.append(batch)
                yield batch.column("tree")

        for at in _numbers(trees(), offsets.get(TaskContext.get().partitionId(), 0)):
            yield held.pop().append_column("idx", pa.array(at, pa.int64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    return ordered.mapInArrow(number, f"{kinds}, idx long")


def _starts(values: pa.Array) -> np.ndarray:
    if not len(values):
        return np.zeros(0, np.int64)
    codes = values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(codes[1:] != codes[:-1]) + 1))


def _in_order(block: pa.Table) -> tuple[pa.Table, int]:
    block = block.sort_by("idx")
    return block, height_of(block.column("idx")[0].as_py() // BLOCK, block.num_rows)


def _above(nodes: DataFrame) -> DataFrame:
    """(tree, idx, digest) of the roots of all blocks of ``nodes``."""

    def roots(key: tuple, block: pa.Table) -> pa.Table:
        block, height = _in_order(block)
        top = walk(block.column("digest").to_pylist(), height)
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "idx": pa.array([key[1].as_py()], pa.int64()), "digest": [top]})

    blocks = nodes.select("tree", (F.col("idx") / BLOCK).cast("long").alias("block"), "idx", "digest")
    return frozen(blocks.groupBy("tree", "block").applyInArrow(roots, "tree string, idx long, digest string"))


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and what stands above them, block by block, up to one node a tree."""
    levels = [nodes]
    while len(levels) == 1 or not levels[-1].filter("idx > 0").isEmpty():
        levels.append(_above(levels[-1]))
    return levels


def _below(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with the proofs (steps) that ``above`` (tree, idx, steps, ...) continues, and its other columns."""
    own = [c for c in nodes.columns if c not in ("tree", "idx", "digest")]
    given = [c for c in above.columns if c not in ("tree", "idx", "steps")]
    rows = nodes.withColumn("block", (F.col("idx") / BLOCK).cast("long"))

    def proved(block: pa.Table, top: pa.Table) -> pa.Table:
        block, height = _in_order(block.drop_columns(["block"]))
        proofs: list[list[tuple[str, str]]] = [[] for _ in range(block.num_rows)]
        walk(block.column("digest").to_pylist(), height, proofs)
        rest = [(s["before"], s["after"]) for s in top.column("steps")[0].as_py()]
        steps = [s for proof in proofs for s in (*proof, *rest)]
        pairs = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.string()), pa.array([s[1] for s in steps], pa.string())], ["before", "after"])
        out = block.append_column("steps", pa.ListArray.from_arrays(pa.array(np.arange(block.num_rows + 1, dtype=np.int32) * (height + len(rest))), pairs))
        for c in given:
            value = top.column(c)
            out = out.append_column(c, pa.array([value[0].as_py()] * block.num_rows, value.type))
        return out.select(["tree", "idx", "digest", *own, "steps", *given])

    kinds = {f.name: f.dataType.simpleString() for f in (*nodes.schema, *above.schema)}
    schema = ", ".join(f"`{c}` {STEPS if c == 'steps' else kinds[c]}" for c in ["tree", "idx", "digest", *own, "steps", *given])
    return rows.groupBy("tree", "block").cogroup(above.groupBy("tree", "idx")).applyInArrow(proved, schema)


@dataclass
class Manifest:
    """``root`` (null for a table without rows); ``subroots`` (tree, digest); ``leaves``: (tree, key, digest, idx) and the other columns
    that were given, all in the shared checkpoint folder."""

    root: str | None
    subroots: DataFrame
    leaves: DataFrame
    _levels: list[DataFrame]
    _tops: list[DataFrame]

    def proofs(self) -> DataFrame:
        """``leaves`` with ``subroot``, ``root`` and ``steps``: the siblings before and after the leaf and each node above it, as
        concatenated hex digests, lowest first, up to the root. Made block by block and not stored."""
        start = self._tops[-1].select("tree", "idx", F.expr(f"cast(array() as {STEPS})").alias("steps"))
        for level in reversed(self._tops[:-1]):
            start = _below(level, start.select("tree", "idx", "steps"))
        above = frozen(start.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("idx"), F.col("digest").alias("subroot"), "steps"))
        for level in reversed(self._levels[1:-1]):
            above = frozen(_below(level, above).drop("digest"))
        return _below(self.leaves, above).withColumn("root", F.lit(self.root).cast("string"))


def manifest(leaves: DataFrame) -> Manifest:
    """The tree over ``leaves``: tree (string), key (any type that sorts), digest (hex), and columns that proofs carry along.

    Leaves stand by key, null first, then by digest; a null tree is one like others and the first. Repeated rows are leaves
    each. A table without rows has no root and no proofs. Nothing but digests and these columns is held, so a text's length
    is no matter here.
    """
    levels = _climbed(indexed(leaves))
    subroots = levels[-1].select("tree", "digest")
    # The trees' subroots are the leaves of one more tree, by name.
    tops = _climbed(indexed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")))
    found = tops[-1].select("digest").head()
    return Manifest(found[0] if found else None, subroots, levels[0], levels, tops)


def proof_digest(steps: Column) -> Column:
    """SHA-256 of a proof's digests, level by level, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""
    return F.aggregate(steps, start, lambda node, s: digest(s["before"], node, s["after"]))
