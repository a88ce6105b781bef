"""Queries by name over the test tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.plans.marts import INTERMEDIATE, MARTS
from caseworks.workload import check_queries, domain, load_queries, operator_queries, source_queries
from caseworks.workload.mart_checks import mart_sql

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Days and decimals as text, so that every client reads the same values and compares them exactly."""

    def plain(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind == "date":
            return column.cast("string").alias(name)
        if not kind.startswith("decimal"):
            return column
        scale = domain.EXACT_SCALE
        return (column.cast(f"decimal(28,{scale})") * F.lit(10**scale)).cast("decimal(38,0)").cast("string").alias(name)

    return df.select(*[plain(name, kind) for name, kind in df.dtypes])


def _portable(build: Query) -> Query:
    return lambda spark, sf_dir: portable(build(spark, sf_dir))


def _mart(name: str) -> Query:
    build = (MARTS | INTERMEDIATE)[name]
    return lambda spark, sf_dir: build(domain.source(spark, sf_dir))


def queries() -> dict[str, Query]:
    built = {name: _mart(name) for name in MARTS | INTERMEDIATE}
    built |= operator_queries.QUERIES | check_queries.QUERIES | source_queries.QUERIES | load_queries.QUERIES
    return {name: _portable(build) for name, build in built.items()}


def oracle_sql() -> dict[str, str]:
    return mart_sql() | operator_queries.CHECKS | check_queries.CHECKS | source_queries.CHECKS | load_queries.CHECKS
