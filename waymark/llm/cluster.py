"""Small helpers that every operator here shares: lineage cuts, worker paths, Arrow slices.

Nothing in this module depends on the size of the data.
"""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker turns into arrays at once.
SLICE_BYTES = 1 << 20


#: Rows of a narrow table in one file of a checkpoint.
ROWS_A_FILE = 250_000
#: Rows in an Arrow batch; with texts of some kB the usual 10,000 take tens of MB on both sides of every Python task.
BATCH_ROWS = "2000"


#: Environment of Python workers, which Spark reuses for one stage after the other: without it each keeps what its largest
#: batch took, 50 to 100 MB.
WORKERS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "4000000"}


#: Whether files of a checkpoint go when nothing refers to it any more; on unless the session says otherwise.
CLEANED = "spark.cleaner.referenceTracking.cleanCheckpoints"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package and give freed memory back (allocator settings of their environment), name a
    checkpoint folder, and lower the size of Arrow batches where the session leaves it at its default (for the whole
    session, as plans run after this returns).

    The folder is the one of spark.checkpoint.dir. Where none is set a local one is made in local mode only (tests): on a
    cluster executors would not share it, so that is an error.
    """
    sc = spark.sparkContext
    conf = sc._jsc.sc().conf()
    if not conf.contains(CLEANED):
        conf.set(CLEANED, "true")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc.environment.setdefault("PYTHONPATH", root)
    for name, value in WORKERS.items():
        sc.environment.setdefault(name, value)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="waymark-"))


def frozen(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` computed once and read back from the shared checkpoint folder, so that a lost executor costs no recomputation.

    With a bound of its rows, it is written in no more files than that needs: a small table in hundreds of files costs
    more than the table.
    """
    prepare(df.sparkSession)
    if rows is not None:
        df = df.coalesce(rows // ROWS_A_FILE + 1)
    return df.checkpoint(eager=True)


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object] | None = None) -> object:
    """An object that a Python worker keeps between tasks, made on first use.

    A worker holds one at a time: asking for another name lets go of it, so the tables of one operator do not stay in
    memory while a worker that Spark reuses runs the next one. Without ``make`` everything is let go.
    """
    if name not in _HELD:
        _HELD.clear()
        gc.collect()
        if make is not None:
            _HELD[name] = make()
    return _HELD.get(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; the offsets start at 0. Nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32, len(array) + 1 + array.offset)[array.offset :].astype(np.int64)
    if not len(array) or offsets[-1] == offsets[0] or array.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``limit`` bytes; a longer row is a run of its own, whole."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi
