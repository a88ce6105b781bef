"""Tables made of committed batches: appended once per load, replaced as a whole, or merged by key.

A table is a folder. Every load writes a folder of its own beside the others, ``_batch=<load>.<attempt>``, and becomes
part of the table by one small file in ``_log``, which is put in place by a rename that fails if the name is taken.
A load that fails leaves the table as it was; one that is run again under its old name changes nothing; two writers
commit one after the other. Files are plain Parquet. The log holds what a load brought, so that reports need no pass.

Both kinds of table are read by ``read``. A folder that holds nothing but appended or just replaced data can be read
as plain Parquet as well, except for what failed attempts have left there (``sweep`` removes that).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.operators.reshape import quoted
from caseworks.operators.rows import deduplicate
from caseworks.session import remove_folder

BATCH, BUCKET, LOG, SOURCES = "_batch", "_bucket", "_log", "_sources"
FILE, MODIFIED = "_source_file", "_source_modified"
APPEND, REPLACE, MERGE = "append", "replace", "merge"
ENTRY = """version bigint, load string, action string, folder string, buckets array<int>, n_buckets int, schema string,
    rows bigint, rejected bigint, rejects string, last_stamp string, sources boolean, committed_at double"""


@dataclass(frozen=True)
class Loaded:
    """What a load brought; the same for a load that had been committed before."""

    get: dict[str, Any]
    repeated: bool = False


class Conflict(Exception):
    """Another load has changed the same buckets meanwhile."""


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # The log.

    def log(self) -> DataFrame:
        """One row per committed load."""
        files = f"{self.path}/{LOG}/*.json"
        if not self._found(files):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(files)

    def commits(self) -> list[T.Row]:
        return sorted(self.log().collect(), key=lambda entry: entry.version)

    def committed(self, load: str) -> T.Row | None:
        return next((entry for entry in self.commits() if entry.load == load), None)

    def _commit(self, entry: dict[str, Any], seen: int | None = None) -> None:
        """Add an entry under the next version. With ``seen``, the version that the load has read, nothing committed
        since may touch the same buckets."""
        while True:
            before = self.commits()
            if any(other.load == entry["load"] for other in before):
                return
            for other in before if seen is not None else ():
                if other.version > seen and (other.action != MERGE or set(other.buckets) & set(entry["buckets"])):
                    raise Conflict(entry["load"])
            version = before[-1].version + 1 if before else 0
            text = json.dumps(entry | {"version": version, "committed_at": time.time()})
            if self._put(f"{self.path}/{LOG}/{version:020d}.json", text):
                return

    # Reading.

    def _live(self, commits: Sequence[T.Row]) -> dict[str, tuple[str, T.Row]]:
        """Paths of the data that make up the table, by what a later load would take the place of."""
        live: dict[str, tuple[str, T.Row]] = {}
        for entry in commits:
            if entry.action == REPLACE:
                live = {}
            if entry.action == MERGE:
                live |= {f"{BUCKET}={b}": (f"{entry.folder}/{BUCKET}={b}", entry) for b in entry.buckets}
            else:
                live[entry.folder] = entry.folder, entry
        return live

    def read(self, version: int | None = None, marks: bool = False, buckets: Sequence[int] | None = None) -> DataFrame:
        """The committed rows, now or at an earlier version whose data are kept. ``marks`` adds the batch of each row.

        Columns that some batches lack are NULL there. The schema is in the log, so no file is opened for it.
        """
        commits = [entry for entry in self.commits() if version is None or entry.version <= version]
        if not commits:
            raise FileNotFoundError(f"no committed table at {self.path}")
        live = self._live(commits)
        if buckets is not None:
            live = {key: live[key] for key in (f"{BUCKET}={b}" for b in buckets) if key in live}
        schema = reduce(_merged, [T.StructType.fromJson(json.loads(entry.schema)) for entry in commits])
        if live:
            schema = reduce(_merged, [T.StructType.fromJson(json.loads(entry.schema)) for _, entry in live.values()])
        columns = [quoted(c) for c in schema.names]
        if not live:
            return self.spark.createDataFrame([], schema)
        marked = [BATCH, BUCKET] if any(entry.action == MERGE for _, entry in live.values()) else [BATCH]
        whole = T.StructType([*schema.fields, *[T.StructField(c, T.IntegerType() if c == BUCKET else T.StringType()) for c in marked]])
        rows = self.spark.read.schema(whole).option("basePath", self.path).parquet(*[f"{self.path}/{p}" for p, _ in live.values()])
        return rows.select(*columns, *([BATCH] if marks else []))

    def sources(self) -> DataFrame:
        """The files that committed loads have read, with their times of modification."""
        paths = [f"{self.path}/{SOURCES}/{entry.folder.partition('=')[2]}" for entry in self.commits() if entry.sources]
        schema = f"{FILE} string, {MODIFIED} timestamp"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # Writing.

    def append(self, df: DataFrame, load: str | None = None, **more: Any) -> Loaded:
        """Add rows once per load."""
        return self._write(df, load, APPEND, **more)

    def replace(self, df: DataFrame, load: str | None = None, keep: int = 0, **more: Any) -> Loaded:
        """Put rows in the place of the whole table. Until the commit, and if the load fails, readers see the old rows.

        Then the data of all but the last ``keep`` former versions are removed; a reader that is still at work on a
        version needs it kept.
        """
        loaded = self._write(df, load, REPLACE, **more)
        self._retire(keep)
        return loaded

    def merge(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[Column], load: str | None = None, n_buckets: int = 64,
        stamp: str | None = None, **more: Any,
    ) -> Loaded:
        """Keep one row per key, the first in ``order`` of those in the table and those given.

        The table is dealt into buckets by a hash of the key (``n_buckets`` counts for the first load only; a bucket is
        written by one task). Only the buckets that the new rows touch are read and written again. Of equal rows in
        order the new one stays. A former version of a bucket stays until ``retire``.
        """
        load = load or uuid.uuid4().hex
        draft, given = f"{self.path}/_draft/{uuid.uuid4().hex}", Observation()
        measures = [F.count(F.lit(1)).alias("rows"), *([F.max(stamp).alias("last")] if stamp else [])]
        try:
            # Written once: it is read for the buckets it touches, and once for every attempt to merge.
            deduplicate(df.observe(given, *measures), keys, order).write.parquet(draft)
            more |= {"rows": given.get["rows"], "last_stamp": given.get.get("last")}
            while True:
                commits = self.commits()
                done = next((entry for entry in commits if entry.load == load), None)
                if done is not None:
                    return Loaded({"rows": done.rows}, repeated=True)
                n = next((entry.n_buckets for entry in commits if entry.action == MERGE), n_buckets)
                bucket = F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(n)).cast("int").alias(BUCKET)
                rows = self.spark.read.schema(df.schema).parquet(draft).select("*", bucket, F.lit(True).alias("_new"))
                touched = sorted(row[0] for row in rows.select(BUCKET).distinct().collect())  # n at most
                if commits and touched:
                    old = self.read(buckets=touched).select("*", bucket, F.lit(False).alias("_new"))
                    rows = rows.unionByName(old, allowMissingColumns=True)
                # Dealt by bucket once, for the choice and for the files.
                rows = deduplicate(rows.repartition(BUCKET), [BUCKET, *keys], [*order, F.desc("_new")]).drop("_new")
                try:
                    return self._write(rows, load, MERGE, touched, n, commits[-1].version if commits else -1, **more)
                except Conflict:
                    continue
        finally:
            remove_folder(self.spark, draft)

    def _write(
        self, df: DataFrame, load: str | None, action: str, buckets: Sequence[int] | None = None, n_buckets: int | None = None,
        seen: int | None = None, sources: DataFrame | None = None, stamp: str | None = None, **more: Any,
    ) -> Loaded:
        """Write the rows, then commit them. ``stamp`` names the column whose largest value goes to the log."""
        load = load or uuid.uuid4().hex
        done = self.committed(load)
        if done is not None:
            return Loaded({"rows": done.rows}, repeated=True)
        name = f"{load}.{uuid.uuid4().hex[:12]}"
        counted = Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"), *([F.max(stamp).alias("last_stamp")] if stamp else [])).write
        (rows.partitionBy(BUCKET) if action == MERGE else rows).parquet(f"{self.path}/{BATCH}={name}")
        if sources is not None:
            sources.write.parquet(f"{self.path}/{SOURCES}/{name}")
        fields = T.StructType([f for f in df.schema.fields if f.name != BUCKET])
        entry = {"load": load, "action": action, "folder": f"{BATCH}={name}", "schema": fields.json(), "rejected": 0}
        entry |= {"buckets": list(buckets or []), "n_buckets": n_buckets, "sources": sources is not None} | counted.get | more
        self._commit(entry, seen)
        return Loaded({"rows": entry["rows"]})

    # Clearing away.

    def _retire(self, keep: int) -> None:
        """Remove the data that only versions before the last ``keep`` ones use."""
        commits = self.commits()
        used = {path for n in range(max(1, len(commits) - keep), len(commits) + 1) for path, _ in self._live(commits[:n]).values()}
        for path in {path for n in range(1, len(commits) + 1) for path, _ in self._live(commits[:n]).values()} - used:
            remove_folder(self.spark, f"{self.path}/{path}")

    def retire(self, keep: int = 0) -> None:
        """Remove former versions of replaced tables or merged buckets, all but the last ``keep``."""
        self._retire(keep)

    def sweep(self, hours: float = 24) -> list[str]:
        """Remove what attempts have left that were never committed, once it is older than any load takes."""
        known, limit = {entry.folder for entry in self.commits()}, (time.time() - 3600 * hours) * 1000
        gone = []
        for status in self._found(f"{self.path}/{BATCH}=*"):
            name = status.getPath().getName()
            if name not in known and status.getModificationTime() < limit:
                remove_folder(self.spark, f"{self.path}/{name}")
                gone.append(name)
        return gone

    # Files of the log, in whatever store the table lies.

    def _found(self, pattern: str) -> list:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        return list(path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or [])

    def _put(self, name: str, text: str) -> bool:
        """Write a small file whole, unless there is one of that name."""
        jvm, settings = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        fs = jvm.org.apache.hadoop.fs
        final = fs.Path(name)
        draft = fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
        stream = final.getFileSystem(settings).create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        store = fs.FileContext.getFileContext(final.toUri(), settings)
        try:
            store.rename(draft, final, how)
        except Py4JJavaError as error:
            final.getFileSystem(settings).delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True


def _merged(one: T.StructType, other: T.StructType) -> T.StructType:
    """The columns of both; a column may not change its type."""
    kinds = {f.name: f.dataType for f in one.fields}
    for f in other.fields:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name!r} is {kinds[f.name].simpleString()} in one batch and {f.dataType.simpleString()} in another")
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in one.fields], *[T.StructField(f.name, f.dataType) for f in other.fields if f.name not in kinds]])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return Table(spark, path).read(version)
