"""Incremental landing: every new document lands once, rejects are kept, the newest copy wins."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caseworks.sources.landing import REJECT, STAMP, accepted, clean_fields, parse_documents, rejected
from caseworks.sources.tables import BATCH, FILE, MODIFIED, Table

LANDED = "_landed_at"
# The file source leaves out files older than this, counted from the newest file. A century: none.
OLDEST_FILE = "36500d"
N_BUCKETS = 64


def _documents(lines: DataFrame, schema: str) -> DataFrame:
    """Documents, one per line, with their file and its time."""
    modified = F.col("_metadata.file_modification_time")
    lines = lines.select("value", modified.alias(LANDED), F.col("_metadata.file_path").alias(FILE), modified.alias(MODIFIED))
    return parse_documents(lines.filter(F.trim("value") != ""), schema)


def document_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Documents of every file that arrives, one per line, with their file and its time."""
    return _documents(spark.readStream.option("maxFileAge", OLDEST_FILE).text(folder), schema)


def _land(batch: DataFrame, table: Table, rejects: str, load: str, keys: Sequence[str], n_buckets: int) -> None:
    """One batch: its documents and its rejects become part of the table in one commit, or nothing does."""
    if table.committed(load) is not None:
        return
    named = FILE in batch.columns
    if named:
        # Without files that a commit has brought already, by another feed or by this one before it lost its progress.
        batch = batch.join(table.sources(), [FILE, MODIFIED], "left_anti")
    batch.persist()
    try:
        moment = F.date_format(LANDED, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        good = clean_fields(accepted(batch).withColumn(STAMP, moment).drop(LANDED, FILE, MODIFIED))
        counted, folder = Observation(), f"{BATCH}={load}.{uuid.uuid4().hex[:12]}"
        rejected(batch).observe(counted, F.count(F.lit(1)).alias("rows")).write.text(f"{rejects}/{folder}")
        more = {"rejected": counted.get["rows"], "rejects": folder, "stamp": STAMP}
        if named:
            more["sources"] = batch.select(FILE, MODIFIED).distinct()
        if keys:
            table.merge(good, keys, [F.col(STAMP).desc_nulls_last()], load, n_buckets, **more)
        else:
            table.append(good, load, **more)
    finally:
        batch.unpersist()


def land_new(
    documents: DataFrame, path: str, rejects: str, progress: str, keys: Sequence[str] = (), n_buckets: int = N_BUCKETS
) -> StreamingQuery:
    """Land the documents that arrived since the last run, then stop.

    Without ``keys`` every copy is appended, whatever the time of its file: a late file or a corrected resend is one
    more copy, and ``latest`` picks the newest per key on read. With ``keys`` the table holds the newest copy of each
    key only; no copy is too late to be weighed against it. Text that does not parse goes to ``rejects`` as it came.

    ``progress`` is the checkpoint folder; the next run resumes there. A batch is committed under the stream's own
    id and its number, so that several feeds share a table and a batch that is run again brings nothing twice. If the
    progress is lost, the feed gets a new id and reads its files again; those in the log of the table are left out
    (for documents of ``document_stream``). Feeds that read the same files must not run at the same time.
    """

    def land(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        feed = json.loads(spark.read.text(f"{progress}/metadata").first().value)["id"]
        _land(batch, Table(spark, path), rejects, f"{feed}-{number}", keys, n_buckets)

    return (
        documents.writeStream.foreachBatch(land)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def land_changed(
    spark: SparkSession, folder: str, schema: str, path: str, rejects: str, keys: Sequence[str] = (), n_buckets: int = N_BUCKETS
) -> list[str]:
    """Land the files of a folder that were written anew under a name the stream has read before, and name them.

    A stream knows its files by name only. What the table's log has not seen at its present time of modification is
    read here; run it when the stream has stopped. The number of such files is expected to be small.
    """
    table = Table(spark, path)
    files = spark.read.format("binaryFile").load(folder)  # only names and times are read
    files = files.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias(MODIFIED))
    names = files.select(FILE).join(table.sources().select(FILE).distinct(), FILE, "left_semi")
    changed = files.join(table.sources(), [FILE, MODIFIED], "left_anti").join(names, FILE, "left_semi").orderBy(FILE).collect()
    if not changed:
        return []
    said = hashlib.md5("\n".join(f"{row[FILE]} {row[MODIFIED].isoformat()}" for row in changed).encode()).hexdigest()
    paths = [row[FILE] for row in changed]
    _land(_documents(spark.read.text(paths), schema), table, rejects, f"changed-{said}", keys, n_buckets)
    return paths


def committed_rejects(spark: SparkSession, path: str, rejects: str) -> DataFrame:
    """What committed batches could not parse."""
    folders = [entry.rejects for entry in Table(spark, path).commits() if entry.rejects]
    if not folders:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{rejects}/{folder}" for folder in folders]).select("value")
