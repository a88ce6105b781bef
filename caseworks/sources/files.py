"""Delimited files and the naming of raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from caseworks.schemas import BONUS_LINE_COLUMNS

# Physical names of the raw tables, by the source that delivers them.
RAW_NAMES: dict[str, dict[str, str]] = {
    "casework": {"benef": "dt_benef", "rdv": "dt_rdv", "facture": "dt_facture"},
    "finance": {"BDD_BU_NATIVE": "BDD_BU_NATIVE", "BDD_EDM_NATIVE": "BDD_EDM_NATIVE"},
    "training": {
        name: name
        for name in (
            "Presence_Soc_2", "Presence_Soc_3", "Presence_Soc_4", "Inscrite_Soc_2", "Inscrite_Soc_3", "Stage_Soc_2",
            "Stage_Soc_3", "entites",
        )
    },
    "bonus": {
        name: name
        for name in (
            "16866_CVL", "16871_GUAD", "16872_GUAD", "16873_GUAD", "16898_GD_EST", "16900_IDF", "prime_compile_clean",
        )
    },
}


def raw_path(roots: Mapping[str, str], source: str, table: str) -> str:
    """Folder of a raw table: the source's root and the table's physical name."""
    return f"{roots[source]}/{RAW_NAMES[source][table]}"


def read_csv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """CSV with a header line, typed by an explicit schema; the header decides which column is which."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def bonus_file_schema(kinds: Mapping[str, str] | None = None) -> str:
    """Schema of a regional bonus file: text unless a type is given."""
    return ", ".join(f"`{name}` {(kinds or {}).get(name, 'string')}" for name in BONUS_LINE_COLUMNS)


def read_bonus_file(spark: SparkSession, path: str | list[str], kinds: Mapping[str, str] | None = None) -> DataFrame:
    return read_csv(spark, path, bonus_file_schema(kinds))
