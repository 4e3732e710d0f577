"""Tables in versions: files that never change, and a numbered commit that says which of them a version is made of.

A version's files are written first, under names that nobody reads. Then its commit is made by creating a file that must
not be there: of several writers who build on the same version one succeeds, the others begin again from its version.
So readers see whole versions only, can go back to older ones, and a writer that dies leaves files that no commit names.

Records are dealt over buckets by a hash of their key. An upsert reads and rewrites the buckets its rows fall into; a
version is, for each bucket, the folder that last wrote it. A commit also keeps, for each stream that writes here, the
number of its last batch, so a batch that comes again after a failure changes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.records import upsert
from waymark.runtime import frozen

BUCKET = "_bucket"
#: Times that a writer begins again because another one was first.
TRIES = 50


class Conflict(RuntimeError):
    """Another writer has made the version that this one wanted to make."""


class Files:
    """What is needed of the session's file system for a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway, self.fs = spark.sparkContext._gateway, self.place(path).getFileSystem(self.conf)
        self.local = self.fs.getUri().getScheme() == "file"

    def place(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> dict[str, int]:
        """Names in a folder, with the times of their last change in seconds."""
        if not self.fs.exists(self.place(folder)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in self.fs.listStatus(self.place(folder))}

    def read(self, path: str) -> str:
        stream = self.fs.open(self.place(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make a file with its whole content unless there is one; whether it was made.

        The content is written beside it and then given its name in one step that fails where the name is taken: a link on
        a local file system, a rename without overwriting elsewhere, which is atomic on file systems with a name node. A
        store without such a rename needs one commit at a time.
        """
        draft = f"{path}.{uuid.uuid4().hex}"
        out = self.fs.create(self.place(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.local:
                at = lambda p: self.jvm.java.nio.file.Paths.get(self.place(p).toUri().getPath(), self.gateway.new_array(self.jvm.java.lang.String, 0))
                self.jvm.java.nio.file.Files.createLink(at(path), at(draft))
            else:
                kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
                options = self.gateway.new_array(kind, 1)
                options[0] = kind.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.place(path).toUri(), self.conf).rename(self.place(draft), self.place(path), options)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(self.place(draft), False)

    def delete(self, path: str) -> None:
        self.fs.delete(self.place(path), True)


class Snapshots:
    """Versions of a table of records with unique ``key`` columns, in a folder that driver and executors share.

    ``buckets`` is fixed by the first version; take so many that a bucket's records fit well into a task.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | list[str] = "place_code", buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.key = [key] if isinstance(key, str) else list(key)
        self.files = Files(spark, path)

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/commits") if n.endswith(".json"))

    def commit(self, version: int | None = None) -> dict | None:
        """A version's commit, the newest by default; None if there is none."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return json.loads(self.files.read(self._commit_path(version)))

    def _load(self, commit: dict, buckets: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(commit["schema"])
        paths = [f"{self.path}/data/{folder}/{BUCKET}={b}" for b, folder in commit["parts"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The records of a version, the newest by default; later commits do not change what is read."""
        commit = self.commit(version)
        if commit is None:
            raise FileNotFoundError(f"no version in {self.path}")
        return self._load(commit)

    def _write(self, records: DataFrame, buckets: int) -> tuple[str, set[int]]:
        """Files of ``records`` in a new folder, and the buckets that have any."""
        folder = uuid.uuid4().hex
        number = F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")
        records.withColumn(BUCKET, number).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        return folder, {int(n.split("=")[1]) for n in self.files.names(f"{self.path}/data/{folder}") if n.startswith(BUCKET)}

    def _make(self, base: dict | None, records: DataFrame, parts: dict[str, str], stream: str | None, batch: int | None, note: dict | None) -> int:
        version = base["version"] + 1 if base else 1
        batches = dict(base["batches"]) if base else {}
        if stream is not None:
            batches[stream] = batch
        whole = {"version": version, "buckets": base["buckets"] if base else self.buckets, "parts": parts, "schema": json.loads(records.schema.json()), "batches": batches, "note": note if note is not None else (base or {}).get("note", {})}
        if not self.files.create(self._commit_path(version), json.dumps(whole)):
            raise Conflict(f"version {version} of {self.path} is there already")
        return version

    def replace(self, records: DataFrame, base: int | None = None, note: dict | None = None) -> int:
        """A version of these records alone. With ``base``, only if that is still the newest (0: none yet); else Conflict."""
        for _ in range(TRIES):
            last = self.commit()
            if base is not None and base != (last["version"] if last else 0):
                raise Conflict(f"version {base} of {self.path} is not the newest")
            folder, there = self._write(records, last["buckets"] if last else self.buckets)
            try:
                return self._make(last, records, {str(b): folder for b in sorted(there)}, None, None, note)
            except Conflict:
                self.files.delete(f"{self.path}/data/{folder}")
                if base is not None:
                    raise
        raise Conflict(f"{self.path} changes all the time")

    def upsert(self, rows: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame] | None = None, stream: str | None = None, batch: int | None = None) -> int:
        """The version that holds ``rows``: a new one, or for a batch that was folded in before the newest.

        ``fold`` (old, new) makes the records of the keys' buckets; by default rows replace records with their key, which must
        be unique among them. It is run again on the newer version if another writer was first. ``rows`` are computed once.
        """
        rows = frozen(rows)
        for _ in range(TRIES):
            last = self.commit()
            if last and stream is not None and last["batches"].get(stream, -1) >= batch:
                return last["version"]
            number = last["buckets"] if last else self.buckets
            touched = {r[0] for r in rows.select(F.pmod(F.xxhash64(*self.key), F.lit(number)).cast("int")).distinct().collect()}
            old = self._load(last, touched) if last else self.spark.createDataFrame([], rows.schema)
            merged = fold(old, rows) if fold else self._replaced(old, rows)
            folder, there = self._write(merged, number)
            kept = {b: f for b, f in (last["parts"] if last else {}).items() if int(b) not in touched}
            try:
                return self._make(last, merged, kept | {str(b): folder for b in sorted(there)}, stream, batch, None)
            except Conflict:
                self.files.delete(f"{self.path}/data/{folder}")
        raise Conflict(f"{self.path} changes all the time")

    def _replaced(self, old: DataFrame, rows: DataFrame) -> DataFrame:
        if len(self.key) == 1:
            return upsert(old, rows, self.key[0])
        return old.join(rows.select(*self.key), self.key, "left_anti").unionByName(rows, allowMissingColumns=True)

    def sink(self, stream: str, fold: Callable[[DataFrame, DataFrame], DataFrame] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: folds each micro-batch of the stream of that name in once, whatever is repeated."""

        def take(rows: DataFrame, batch: int) -> None:
            self.upsert(prepare(rows) if prepare else rows, fold, stream, batch)

        return take

    def vacuum(self, keep: int = 14, older_than_s: float = 86_400.0) -> list[str]:
        """Delete all but the newest ``keep`` commits, and folders that none of those names, if they are old enough not to be
        those of a writer who has yet to commit. Returns the folders."""
        known = self.versions()
        for version in known[:-keep]:
            self.files.delete(self._commit_path(version))
        used = {f for v in known[-keep:] for f in self.commit(v)["parts"].values()}
        gone = [f for f, at in self.files.names(f"{self.path}/data").items() if f not in used and time.time() - at >= older_than_s]
        for folder in gone:
            self.files.delete(f"{self.path}/data/{folder}")
        return gone
