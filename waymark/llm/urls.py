"""URL filter on a sorted digest array.

Entries are strings, ``host + path prefix``, or ``*word`` for every host with that word, each with a verdict. Their 64-bit
xxhash keys are sorted into one array that every executor maps into memory; beside it lie the full strings. A url is
looked up under each of its host's suffixes (cut at labels, no longer than an entry's) joined with each path prefix of a
length that occurs among the entries, and under its host's words. Keys of probes are made by the JVM; all of a batch are
probed by one vectorised binary search, and a hit counts only if the stored string equals the probe. The longest entry
that fits gives the verdict.

The array is built from a table: Spark hashes and sorts the entries, and each range of keys becomes a row of packed bytes
in Parquet files of the shared checkpoint folder. Spark's own file distribution brings them to the executors (to one that
joins later, too); there one worker puts the ranges together beside the files, and all workers of the executor map that
file read-only. Lists of at most FEW entries are packed on the driver.
"""

from __future__ import annotations

import fcntl
import io
import mmap
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import prepare

#: Precedence rules of the url policy: (host and path prefix, verdict).
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
#: Setting that names a block list: a text file (one entry a line, # begins a comment) or a Parquet table with a column ``host``.
BLOCK_LIST = "spark.waymark.urls.blockList"
#: The list where none is given: words of host names, by the usual subjects of block lists (adverts, adult, gambling, drugs, fraud).
BLOCKED_WORDS = tuple(
    "ad ads adserver advert adverts popunder "
    "adult escort escorts hentai porn porno sex sexcam xxx "
    "bet bets betting casino casinos gambling jackpot lottery lotto poker roulette slots "
    "cialis pharma pills steroids viagra "
    "keygen malware phishing scam spam warez".split()
)
#: Entries that are packed on the driver, some hundred kB.
FEW = 5000
#: Entries in one range of keys.
RANGE = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, path without query and fragment; both empty without ``://`` and for a null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


class Shape(NamedTuple):
    """Of an index: its name, the path lengths of its entries, the most labels of a host, and whether there are words."""

    name: str
    files: tuple[str, ...]
    lengths: tuple[int, ...]
    labels: int
    words: bool


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of packed bytes for every batch of sorted entries (key, entry, block)."""
    for batch in batches:
        if batch.num_rows:
            text = [x.encode() for x in batch.column(1).to_pylist()]
            keys = batch.column(0).to_numpy()
            size, block = np.array([len(x) for x in text], np.int64), batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([keys[0]], pa.int64()), *(pa.array([x], pa.binary()) for x in (keys.tobytes(), size.tobytes(), block.tobytes(), b"".join(text)))], ["first", "keys", "size", "block", "text"])


def assemble(paths: list[str], target: str) -> None:
    """Put the ranges of all files into ``target``: their number, keys, offsets of the strings, verdict bytes, strings.

    Sections are written one after the other, each read again row group by row group, so that no more than one of a section is
    held besides 8 bytes an entry for the offsets.
    """
    files = [pq.ParquetFile(path) for path in paths]
    # Every range is a row; row groups hold few of them, whose first keys tell the order.
    order = sorted((first, f, g, i) for f, file in enumerate(files) for g in range(file.num_row_groups) for i, first in enumerate(file.read_row_group(g, ["first"]).column(0).to_pylist()))

    def section(name: str) -> Iterator[bytes]:
        last, column = None, None
        for _, f, g, i in order:
            if last != (f, g):
                last, column = (f, g), files[f].read_row_group(g, [name]).column(0)
            yield column[i].as_py()

    size = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in section("size"))])
    own = f"{target}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(np.int64(len(size)).tobytes())
        out.writelines(section("keys"))
        out.write(np.concatenate(([0], np.cumsum(size))).astype(np.int64).tobytes())
        out.writelines(section("block"))
        out.writelines(section("text"))
    os.replace(own, target)  # whole or not at all


class Index:
    """The mapped index. ``keys`` and strings are views of the file; nothing is copied."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self.map, np.int64, 1)[0])
        self.keys = np.frombuffer(self.map, np.int64, n, 8)
        self.offsets = np.frombuffer(self.map, np.int64, n + 1, 8 + 8 * n)
        self.block = np.frombuffer(self.map, np.uint8, n, 16 + 16 * n)
        self.text = 16 + 17 * n

    def string(self, j: int) -> bytes:
        return self.map[self.text + self.offsets[j] : self.text + self.offsets[j + 1]]

    def lookup(self, keys: np.ndarray, probes: pa.Array) -> np.ndarray:
        """The entry of each probe, or -1. Stored strings decide among equal keys."""
        found = np.full(len(keys), -1)
        if not len(self.keys) or not len(keys):
            return found
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys).tolist():
            j, probe = int(at[i]), probes[i].as_py().encode()
            while j < len(self.keys) and self.keys[j] == keys[i]:
                if self.string(j) == probe:
                    found[i] = j
                    break
                j += 1
        return found


@lru_cache(maxsize=4)
def _index(shape: Shape) -> Index:
    folder = SparkFiles.getRootDirectory()
    target = f"{folder}/{shape.name}.map"
    # One worker of the executor builds it, the others wait.
    with open(f"{target}.lck", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(target):
            assemble([SparkFiles.get(f) for f in shape.files], target)
    return Index(target)


def _few(spark: SparkSession, entries: list[tuple[str, bool]]) -> Shape:
    """The index of at most FEW entries, packed where they are."""
    block: dict[str, bool] = {}
    for entry, blocks in entries:
        if block.setdefault(entry, blocks) != blocks:
            raise ValueError("entries of one host and path differ in verdict")
    signed = lambda e: int(np.uint64(xxhash.xxh64_intdigest(e.encode(), 42)).astype(np.int64))
    rows = sorted((signed(e), e, b) for e, b in block.items())
    name = f"urls-{len(rows)}-{xxhash.xxh64_hexdigest(repr(rows).encode())}"
    files = (f"{name}.index",) if rows else ()
    sc = spark.sparkContext
    if files and files[0] not in {os.path.basename(f) for f in sc.listFiles}:
        (ranges,) = pack([pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], ["key", "entry", "block"])])
        held = io.BytesIO()
        pq.write_table(pa.Table.from_batches([ranges]), held)
        place = sc._jvm.org.apache.hadoop.fs.Path(f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}/{files[0]}")
        out = place.getFileSystem(sc._jsc.hadoopConfiguration()).create(place)
        out.write(held.getvalue())
        out.close()
        sc.addFile(place.toString())
    hosts = [e.partition("/") for e in block if not e.startswith("*")]
    lengths = tuple(sorted({len(slash + path) for _, slash, path in hosts}))
    return Shape(name, files, lengths, max((len(h.split(".")) for h, _, _ in hosts), default=0), any(e.startswith("*") for e in block))


def distribute(entries: DataFrame) -> Shape:
    """Build the index of ``entries`` (entry, verdict) in the shared checkpoint folder and add it to the session's files.

    Null and repeated entries count once; entries of one string must agree. The name tells the content, so an index that
    the session has already is the same one. FEW entries or less are packed at once, without jobs of their own.
    """
    spark = entries.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    first = entries.filter("entry is not null").select("entry", F.coalesce(F.col("verdict") == "block", F.lit(False))).limit(FEW + 1).collect()
    if len(first) <= FEW:
        return _few(spark, [tuple(r) for r in first])
    rows = entries.filter("entry is not null").groupBy("entry").agg(F.max(F.col("verdict") == "block").alias("block"), F.min(F.col("verdict") == "block").alias("other"))
    slash, word = F.instr("entry", "/"), F.startswith("entry", F.lit("*"))
    host = F.when(slash > 0, F.substring(F.col("entry"), F.lit(1), slash - 1)).otherwise(F.col("entry"))
    length = F.when(slash > 0, F.length("entry") - slash + 1).otherwise(0)
    told = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("entry", "block").cast("decimal(20,0)")).alias("sum"),
        F.collect_set(F.when(~word, length)).alias("lengths"),
        F.max(F.when(~word, F.size(F.split(host, "\\.")))).alias("labels"),
        F.count(F.when(word, 1)).alias("words"),
        F.count(F.when(F.col("block") != F.col("other"), 1)).alias("differ"),
    ).first()
    if told.differ:
        raise ValueError("entries of one host and path differ in verdict")
    name = f"urls-{told.n}-{str(told.sum).replace('-', 'm')}"
    folder = f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"  # of its own, as another session may build the same
    place = lambda p: sc._jvm.org.apache.hadoop.fs.Path(p)
    fs = place(folder).getFileSystem(sc._jsc.hadoopConfiguration())
    here = {os.path.basename(f) for f in sc.listFiles}
    parts = -(-told.n // RANGE)
    files = tuple(f"{name}-{i}.index" for i in range(parts))
    if not here.issuperset(files):
        keyed = rows.select(F.xxhash64("entry").alias("key"), "entry", "block").repartitionByRange(parts, "key").sortWithinPartitions("key", "entry")
        keyed.mapInArrow(pack, "first long, keys binary, size binary, block binary, text binary").write.option("compression", "none").parquet(folder)
        written = sorted(s.getPath().toString() for s in fs.listStatus(place(folder)) if s.getPath().getName().endswith(".parquet"))
        files = files[: len(written)]
        for path, file in zip(written, files, strict=True):
            fs.rename(place(path), place(f"{folder}/{file}"))
            sc.addFile(f"{folder}/{file}")
    return Shape(name, files, tuple(sorted(told.lengths)), told.labels or 0, told.words > 0)


def probes_of(shape: Shape, host: Column, path: Column) -> Column:
    """Entries that could fit a url, as an array: its host's last labels with path prefixes, and its host's words."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape.labels))), lambda i: F.array_join(F.slice(labels, -i, i), ".")) if shape.labels else F.array().cast("array<string>")

    def with_path(n: int) -> Column:
        return F.transform(suffixes, lambda s: F.when(F.length(path) >= n, F.concat(s, F.substring(path, 1, n))))

    hosts = [with_path(n) for n in shape.lengths]
    words = [F.transform(F.array_distinct(F.split(host, "[^a-z0-9]+")), lambda w: F.concat(F.lit("*"), w))] if shape.words else []
    return F.when(host != "", F.array_compact(F.concat(*hosts, *words)) if hosts or words else F.array().cast("array<string>")).otherwise(F.array().cast("array<string>"))


def blocked_words(spark: SparkSession) -> DataFrame:
    """BLOCKED_WORDS as entries."""
    return spark.createDataFrame([(f"*{w}",) for w in BLOCKED_WORDS], "host string")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a block list at a path that Spark reads, in a column host: lower-cased, without dots at the ends, each
    once; null and blank lines and comments are none. A url stands for its host."""
    if path.rstrip("/").endswith(".parquet"):
        given = spark.read.parquet(path).select(F.col("host").cast("string").alias("host"))
    else:
        given = spark.read.text(path).select(F.regexp_replace("value", "#.*", "").alias("host"))
    name = F.regexp_extract(F.trim(F.regexp_replace("host", r"^.*://", "")), r"^[^/?#\s]*", 0)
    entry = F.translate(F.regexp_replace(name, r"^\.+|\.+$", ""), UPPER, LOWER)
    return given.select(entry.alias("host")).filter("host <> ''").distinct()


def block_list(spark: SparkSession) -> DataFrame:
    """The list that the session names in BLOCK_LIST, else BLOCKED_WORDS."""
    path = spark.conf.get(BLOCK_LIST, None)
    return read_list(spark, path) if path else blocked_words(spark)


def judge_urls(pages: DataFrame, rules=RULES, blocked: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, listed.

    ``rule``: the longest fitting entry of ``rules`` or null. ``verdict``: the rule's; without one, block if the host, a
    parent of it or one of its words is in ``blocked`` (column host; default BLOCKED_WORDS), else allow. ``listed`` tells
    whether it is. A null url, or one without ``://``, has an empty host and path, no rule, and is allowed. Repeated rows
    are judged alike; other columns are ignored; an empty table gives an empty one, an empty list blocks nothing.
    """
    spark = pages.sparkSession
    blocked = blocked_words(spark) if blocked is None else blocked
    shapes = distribute(spark.createDataFrame(list(rules), "entry string, verdict string")), distribute(blocked.select(F.col("host").alias("entry"), F.lit("block").alias("verdict")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        policy, hosts = map(_index, shapes)
        for batch in batches:

            def longest(index: Index, column: int, batch=batch) -> list[int]:
                probes, keys = batch.column(column), batch.column(column + 1)
                owner = np.repeat(np.arange(batch.num_rows), np.diff(probes.offsets.to_numpy()))
                hit = index.lookup(keys.flatten().to_numpy(), flat := probes.flatten())
                out, size = [-1] * batch.num_rows, [-1] * batch.num_rows
                for i in np.flatnonzero(hit >= 0).tolist():
                    n = len(flat[i].as_py())
                    if n > size[owner[i]]:
                        out[owner[i]], size[owner[i]] = int(hit[i]), n
                return out

            rule, listed = longest(policy, 3), [j >= 0 for j in longest(hosts, 5)]
            block = [policy.block[j] if j >= 0 else x for j, x in zip(rule, listed, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([policy.string(j).decode() if j >= 0 else None for j in rule], pa.string()),
                    pa.array(["block" if b else "allow" for b in block], pa.string()),
                    pa.array(listed, pa.bool_()),
                ],
                ["page_id", "host", "path", "rule", "verdict", "listed"],
            )

    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.select("*", *(probes_of(s, F.col("host"), F.col("path")).alias(f"p{i}") for i, s in enumerate(shapes)))
    hashed = [c for i in range(2) for c in (F.col(f"p{i}"), F.transform(f"p{i}", lambda p: F.xxhash64(p)))]
    return rows.select("page_id", "host", "path", *(c.alias(f"c{i}") for i, c in enumerate(hashed))).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, listed boolean")
