"""Near-duplicate groups by MinHash banding and sequential Bayesian verification.

1. One pass makes, for each document, its set of word shingles (64-bit hashes), a key of the whole set and a
   signature of 16-bit minima. Documents with equal sets are one class; only class representatives go on, so copies
   are never compared.
2. Representatives that agree in a whole band of the signature share a bucket. Each is paired with the bucket's
   smallest member (a star, not all pairs).
3. Pairs are compared batch by batch of the signature. With a uniform prior the posterior of the similarity after m
   of n agreeing minima is Beta(m+1, n-m+1); a pair is dropped once the probability that its similarity reaches the
   threshold is below ``miss``. What survives is verified exactly on the full sets of the whole texts.
4. Links give components. A bucket whose members are still in several components is searched completely for links
   between them: members outside the bucket's largest component against all members, in blocks of bounded size, with
   the same comparison and exact verification. No bucket, partner or candidate count is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import column_bytes, frozen, held, slices, text_of
from .components import components
from .skew import salted, skew_join, texts_for
from .words import sets_of

#: Signature: BANDS bands of ROWS minima. A pair at similarity 0.85 shares no band with probability 4e-7, at 0.8 5e-5.
BANDS, ROWS = 25, 5
#: Minima compared before each look at the posterior.
BATCH = 25
#: Members in one block of a bucket.
BLOCK = 200
#: And their shingles, about.
BLOCK_SHINGLES = 100_000
_RNG = np.random.default_rng(90210)
_ODD = (_RNG.integers(1 << 31, size=(BANDS * ROWS, 1), dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_XOR = _RNG.integers(1 << 32, size=(BANDS * ROWS, 1), dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16-bit minima of a non-empty set of 64-bit hashes under BANDS * ROWS permutations."""
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 2048):
        y = x[None, i : i + 2048] ^ _XOR
        y *= _ODD
        np.minimum(low, y.min(axis=1), out=low)
    low ^= low >> np.uint32(15)
    low *= np.uint32(0x2C1B3C6D)
    return (low >> np.uint32(16)).astype("<u2")


@lru_cache(maxsize=8)
def least_agreements(threshold: float, miss: float) -> tuple[int, ...]:
    """For each number of compared minima, the fewest agreements with P(similarity >= threshold) >= miss."""
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        for m in range(n + 1):
            logs = m * np.log(s) + (n - m) * np.log1p(-s)
            p = np.exp(logs - logs.max())
            if p[s >= threshold].sum() / p.sum() >= miss:
                out.append(m)
                break
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which rows of the signatures ``a`` and ``b`` are not dropped at any look."""
    live, seen = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, need in enumerate(least):
        at = slice(i * BATCH, (i + 1) * BATCH)
        seen = seen + (a[live, at] == b[live, at]).sum(axis=1)
        keep = seen >= need
        live, seen = live[keep], seen[keep]
    return live


def features(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of every document; key and signature are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("")
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                sets = sets_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_key", "signature"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _signatures(column: pa.Array) -> np.ndarray:
    return column_bytes(column)[0].view("<u2").reshape(len(column), BANDS * ROWS)


def likely(pairs: DataFrame, reps: DataFrame, total: int, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) whose signatures survive the sequential comparison; ``total``: their number before."""
    least = least_agreements(threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            live = survivors(_signatures(batch.column(2)), _signatures(batch.column(3)), least)
            yield batch.select(["a", "b"]).take(pa.array(live))

    heads = pairs.groupBy("b").agg(F.count("*").alias("n")).join(reps.select(F.col("rep").alias("b"), F.col("signature").alias("sb")), "b")
    joined = skew_join(pairs, heads, ["b"], "n", total).join(reps.select(F.col("rep").alias("a"), F.col("signature").alias("sa")), "a")
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def linked(docs: DataFrame, pairs: DataFrame, total: int, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of the full shingle sets, from the whole texts. ``total``: the number of ``pairs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (da, oa), (db, ob), hit = column_bytes(batch.column(2)), column_bytes(batch.column(3)), []
            for lo, hi in slices(oa + ob):
                left = sets_of(da[oa[lo] : oa[hi]], oa[lo : hi + 1] - oa[lo], k)
                right = sets_of(db[ob[lo] : ob[hi]], ob[lo : hi + 1] - ob[lo], k)
                for i, (x, y) in enumerate(zip(left, right, strict=True), lo):
                    both = np.concatenate((x, y))
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    if same and 100 * same >= percent * (len(both) - same):
                        hit.append(i)
            yield batch.select(["a", "b"]).take(pa.array(hit, pa.int64()))

    ids = frozen(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct(), 2 * total)
    texts = texts_for(docs, ids, ids.count())
    dealt, spread = salted(pairs, texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), max(total, 1))
    both = dealt.join(spread, ["b", "salt"]).join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first band in which the signature ``x`` agrees with each row of ``y``; BANDS if none."""
    same = (x == y).reshape(len(y), BANDS, ROWS).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), BANDS)


def across(docs: DataFrame, members: DataFrame, reps: DataFrame, k: int, percent: int, miss: float, most: int) -> DataFrame:
    """Links (a, b) between different components inside buckets of several; members: (band, band_key, rep, comp).

    Members outside a bucket's largest component (ties: smallest component) are cut into blocks by hash, and so are
    all members; each outside block meets each block once. Blocks are bounded in documents and in shingles, whatever
    the bucket's size. A pair is treated only in its first common band. A first pass over signatures keeps the
    documents of a block that have a likely partner; the second brings their texts and verifies exactly. Of several
    links that join the same components in a block, one is returned.
    """
    least = least_agreements(percent / 100, miss)
    # Read for the sizes and four times for the blocks: one row a member, joined once.
    sized = frozen(members.join(reps.select("rep", "n_shingles", "signature"), "rep"))
    sizes = sized.groupBy("band", "band_key", "comp").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w"))
    main = sizes.groupBy("band", "band_key").agg(F.max(F.struct("m", (-F.col("comp")).alias("c"), "w")).alias("top"), F.sum("m").alias("m"), F.sum("w").alias("w"))
    blocks = lambda m, w: F.greatest(F.ceil(m / BLOCK), F.ceil(w / BLOCK_SHINGLES)).cast("int")
    main = frozen(main.select("band", "band_key", (-F.col("top.c")).alias("main"), blocks(F.col("m"), F.col("w")).alias("nm"), blocks(F.col("m") - F.col("top.m"), F.col("w") - F.col("top.w")).alias("nr"), "m"), most)
    tagged = skew_join(sized.drop("n_shingles"), main, ["band", "band_key"], "m", most).drop("m").withColumn("probe", F.col("comp") != F.col("main"))
    block = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    key = ["band", "band_key", "i", "j"]
    whole = tagged.select("*", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("i")).withColumn("j", block("nm")).withColumn("probe", F.lit(False))
    probe = tagged.filter("probe").select("*", F.explode(F.sequence(F.lit(0), F.col("nm") - 1)).alias("j")).withColumn("i", block("nr"))
    rows = whole.select(*key, "rep", "comp", "probe", "signature").union(probe.select(*key, "rep", "comp", "probe", "signature"))

    def partners(left: int, right: np.ndarray, band: int, sig: np.ndarray) -> np.ndarray:
        y = right[survivors(np.broadcast_to(sig[left], (len(right), sig.shape[1])), sig[right], least)]
        return y[_first_shared(sig[left], sig[y]) == band]

    def look(table: pa.Table) -> pa.Table:
        comp, probe, band = table.column("comp").to_numpy(), table.column("probe").to_numpy(), table.column("band")[0].as_py()
        sig, others, has = _signatures(table.column("signature")), np.flatnonzero(~probe), np.zeros(len(probe), bool)
        for x in np.flatnonzero(probe):
            y = partners(x, others[comp[others] != comp[x]], band, sig)
            has[y] = True
            has[x] = len(y) > 0
        return table.filter(pa.array(has)).select([*key, "rep", "comp", "probe"])

    def verify(table: pa.Table) -> pa.Table:
        ids, comp, probe, band = table.column("rep").to_numpy(), table.column("comp").to_numpy().copy(), table.column("probe").to_numpy(), table.column("band")[0].as_py()
        sets = sets_of(*column_bytes(table.column("text")), k)
        sig, others, out = np.stack([signature(s) for s in sets]), np.flatnonzero(~probe), []
        size = np.array([len(s) for s in sets])
        code = np.unique(np.concatenate(sets), return_inverse=True)[1]
        at = np.concatenate(([0], np.cumsum(size)))
        mark = np.zeros(code.max() + 1, bool)
        for x in np.flatnonzero(probe):
            y = partners(x, others[comp[others] != comp[x]], band, sig)
            mark[code[at[x] : at[x + 1]]] = True
            for z in y:
                if comp[z] != comp[x]:
                    same = int(np.count_nonzero(mark[code[at[z] : at[z + 1]]]))
                    if 100 * same >= percent * (size[x] + size[z] - same):
                        out.append((ids[x], ids[z]))
                        comp[comp == comp[z]] = comp[x]
            mark[code[at[x] : at[x + 1]]] = False
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    shape = "band int, band_key long, i int, j int, rep long, comp long, probe boolean"
    # Dealt by block: the rows come dealt by bucket, which would do for the grouping but keeps a bucket in one task. The
    # number is given, as rows are few bytes and much work, so partitions of a usual size would be too few tasks.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = frozen(rows.repartition(tasks, *key).groupBy(*key).applyInArrow(look, shape))
    ids = frozen(kept.select(F.col("rep").alias("doc_id")).distinct(), most)
    texts = texts_for(docs, ids, ids.count())
    return kept.join(texts.withColumnRenamed("doc_id", "rep"), "rep").select(*key, "rep", "comp", "probe", "text").groupBy(*key).applyInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = 1e-6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of distinct ``k``-word shingles have 100 * intersection >= percent * union;
    a component is named by its smallest id. Null or word-less texts have an empty set and are linked with nothing.
    Rows that share an id are one document in the links; a null id gets a null component and is kept. Rows of an
    empty table give none. Other columns are ignored, whatever their names.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    feats = frozen(features(docs, k))
    known = feats.filter("set_key is not null and doc_id is not null")
    reps = frozen(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.count("*").alias("n")))
    band = [F.xxhash64(F.lit(i), F.substring("signature", 1 + 2 * ROWS * i, 2 * ROWS)) for i in range(BANDS)]
    rows = reps.select("rep", F.posexplode(F.array(*band)).alias("band", "band_key"))
    bucket = ["band", "band_key"]
    most = BANDS * reps.count()  # of the rows of every table of buckets
    heads = frozen(rows.groupBy(*bucket).agg(F.min("rep").alias("head"), F.count("*").alias("m")).filter("m > 1").drop("m"), most)
    shared = frozen(rows.join(heads, bucket), most)  # narrow rows; a hot bucket is split by the adaptive planner
    star = frozen(shared.filter("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct(), most)
    pairs = frozen(likely(star, reps, star.count(), percent / 100, miss), most)
    comps = components(linked(docs, pairs, pairs.count(), k, percent).toDF("u", "v"), most)
    member = shared.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(*bucket, "rep", F.coalesce("component", "rep").alias("comp"))
    split = member.groupBy(*bucket).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select(*bucket)
    mixed = member.join(split, bucket, "left_semi")
    more = across(docs, mixed, reps, k, percent, miss, most)
    # The stars found so far stand for the links that made them.
    comps = components(comps.union(more).toDF("u", "v"), most)
    classes = reps.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component"), "n")
    given = feats.select("doc_id", "n_shingles", "set_key")
    joined = skew_join(given.filter("set_key is not null and doc_id is not null"), classes, ["set_key"], "n", known.count()).select("doc_id", "n_shingles", "component")
    out = joined.union(given.filter("set_key is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component")))
    component = F.col("component")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
