"""Landing of nested JSON documents: read, clean names, stamp, split off rejects, append, keep latest."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.operators.reshape import quoted
from caseworks.operators.rows import deduplicate
from caseworks.sources.tables import Loaded, Table

REJECT = "_corrupt_record"
# Lineage column, and the signs replaced by '_' in field names.
STAMP = "_extracted_at"
UNCLEAN = re.compile(r"[$@#.\- ]")


def clean_name(name: str) -> str:
    return UNCLEAN.sub("_", name)


def cleaned_type(kind: T.DataType) -> T.DataType:
    """The same type with clean field names at every depth."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(cleaned_type(kind.elementType), kind.containsNull)
    if not isinstance(kind, T.StructType):
        return kind
    names = [clean_name(f.name) for f in kind.fields]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"field names clash once cleaned: {[f.name for f in kind.fields]}")
    return T.StructType(
        [T.StructField(n, cleaned_type(f.dataType), f.nullable) for n, f in zip(names, kind.fields)]
    )


def clean_fields(df: DataFrame) -> DataFrame:
    """Rename unclean fields, nested ones too. A cast by position: names change, values do not."""
    target = cleaned_type(df.schema)
    return df.select(
        *[
            (quoted(old.name) if old.dataType == new.dataType else quoted(old.name).cast(new.dataType)).alias(new.name)
            for old, new in zip(df.schema.fields, target.fields)
        ]
    )


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the extraction time as ISO text."""
    moment = F.current_timestamp() if at is None else at
    return df.withColumn(STAMP, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def parse_documents(lines: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """JSON text to columns; text that does not parse is kept whole in the reject column.

    ``lines`` may carry further columns; they stay beside the parsed ones.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT}
    parsed = F.from_json(F.col(text), f"{schema}, {REJECT} string", options)
    others = [quoted(c) for c in lines.columns if c != text]
    return lines.withColumn("_doc", parsed).select(*others, "_doc.*")


def read_documents(spark: SparkSession, path: str, schema: str, whole_files: bool = False) -> DataFrame:
    """Read landed JSON with an explicit schema.

    One document per line by default, which Spark can split. With ``whole_files`` each file is one
    response: a JSON list of documents, read file by file.
    """
    if not whole_files:
        return parse_documents(spark.read.text(path).filter(F.trim("value") != ""), schema)
    files = spark.read.text(path, wholetext=True)
    documents = F.from_json("value", T.ArrayType(T.StructType.fromDDL(schema)))
    listed = files.select(F.col("value"), documents.alias("_docs"))
    good = listed.select(F.explode("_docs").alias("_doc")).select("_doc.*").withColumn(REJECT, F.lit(None).cast("string"))
    bad = listed.filter(F.col("_docs").isNull()).select(F.col("value").alias(REJECT))
    return good.unionByName(bad, allowMissingColumns=True)


def accepted(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(REJECT).isNotNull()).select(REJECT)


def quarantine(landed: DataFrame, folder: str, dataset: str, table: str, moment: str) -> str:
    """Keep rejects as they came, under a name that says dataset, table and time."""
    path = f"{folder}/backup_{dataset}_{table}_{moment}"
    rejected(landed).write.mode("append").text(path)
    return path


def append(df: DataFrame, path: str, load: str | None = None) -> Loaded:
    """Append once per ``load``: running a load again, after a failure or not, adds nothing. Gives the row count of
    the same pass."""
    return Table(df.sparkSession, path).append(df, load)


def replace(df: DataFrame, path: str, load: str | None = None, keep: int = 0) -> Loaded:
    """Replace the whole table in one step; if that fails, the old table stays. Gives the row count of the same pass."""
    return Table(df.sparkSession, path).replace(df, load, keep)


def latest(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest copy of each document after repeated loads.

    Keys are real identifiers; a response's running number is none, as it restarts with each response.
    """
    return deduplicate(df, keys, [F.col(STAMP).desc_nulls_last(), *tie_break])
