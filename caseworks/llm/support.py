"""What the operators of this package share: word counts, the shared folder, table reads."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[ \x09-\x0D]+"
WORD = r"[^ \x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def packed(df: DataFrame, *more: Column | str) -> DataFrame:
    """All columns of ``df`` in one struct ``_own``, beside the columns an operator needs. Whatever names ``df`` has,
    they meet none of the operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_own"), *more)


def unpacked(names: list[str]) -> list[Column]:
    return [F.col(f"_own.`{c}`") for c in names]


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="caseworks-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which driver and executors share. Only a session on one machine
    without that setting, as in tests, gets a folder of its own; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder or _own_folder()


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that later steps neither recompute it nor depend on the executors
    that made it. Spark removes the files once the frame is no longer referenced, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def in_parts(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """``df`` in as many parts as its number of rows asks for, if it has more. The steps of a loop over a small frame
    then write a few files each, not one for every part of the widest shuffle."""
    return df.coalesce(1 + rows // each)
