"""The corpus pipeline: ``documents`` through five operators, each stage written as Parquet and read again.

Language ID drops the documents it rejects; line dedup deletes repeated runs of lines and drops documents that
lose all their words; near-dedup keeps the smallest doc_id of each group; mixing repeats or leaves out documents
until every source has its target; the last stage encodes the mix into pieces. All stages but the last return the
columns of their input. NULL texts go in the first stage; an empty table passes through all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.llm import langid, lines, minhash, mixing, pieces
from caseworks.llm.support import shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID by compression, learned from the labels of ``docs``; rejected documents go."""
    rows = langid.identified(docs, langid.learned(docs), into="_language_verdict")
    return rows.filter("NOT _language_verdict.rejected").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup; a document left without a word goes, and ``n_chars`` follows the text."""
    rows = lines.deduplicated(docs, removed="_lines_removed").filter("NOT (_lines_removed > 0 AND text = '')")
    return rows.select(
        *[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup; one document of each group stays."""
    return minhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights; a document is there as often as the mix takes it."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding with merge-dropout, and the digest of what the pieces decode to."""
    return pieces.pieces_and_text(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("merge_dropout", encode_pieces),
]

# Compression, hashing and piece agendas have no SQL form; tests compare the stages with plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The tables between them lie in the shared folder; each is removed once the
    next one is written, and the last one serves the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    home = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{home}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
