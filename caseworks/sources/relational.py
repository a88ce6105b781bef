"""Snapshot of a relational database over JDBC, read in parallel.

No database can be reached where the tests run, so only the read options are tested; the reads
themselves are unverified.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from caseworks.sources.landing import replace, stamp

TABLE_LIST = "(SELECT table_name FROM information_schema.tables WHERE table_schema = DATABASE()) AS found"


def read_options(
    url: str,
    table: str,
    login: Mapping[str, str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 1,
) -> dict[str, str]:
    """Options of one table read; a numeric key and its bounds split it into ``parts`` queries.

    Rows are fetched by cursor, as the fetch size alone has no effect on some drivers: without it a task would hold
    the whole result.
    """
    options = {"url": url, "dbtable": table, "fetchsize": "10000", "useCursorFetch": "true", **login}
    if key and bounds and parts > 1:
        low, high = bounds
        options |= {
            "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts),
        }
    return options


def list_tables(spark: SparkSession, url: str, login: Mapping[str, str]) -> list[str]:
    found = spark.read.format("jdbc").options(**read_options(url, TABLE_LIST, login)).load()
    return [row[0] for row in found.collect()]


def read_table(
    spark: SparkSession, url: str, table: str, login: Mapping[str, str], key: str | None = None, parts: int = 1
) -> DataFrame:
    """One table; with a key its bounds are asked for first, so that the parts cover the whole range."""
    bounds = None
    if key and parts > 1:
        ends = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) AS ends"
        row = spark.read.format("jdbc").options(**read_options(url, ends, login)).load().first()
        bounds = (int(row.low), int(row.high)) if row and row.low is not None else None
    return spark.read.format("jdbc").options(**read_options(url, table, login, key, bounds, parts)).load()


def table_key(table: str, keys: Mapping[str, str], small: Collection[str]) -> str | None:
    """The key a table is split by. Only tables named as small are read by one task."""
    if table not in keys and table not in small:
        raise ValueError(f"{table} needs a numeric key to be read in parts, or must be named as small")
    return keys.get(table)


def snapshot(
    spark: SparkSession,
    url: str,
    login: Mapping[str, str],
    path: str,
    keys: Mapping[str, str],
    parts: int,
    small: Collection[str] = (),
) -> dict[str, int]:
    """Replace every table under ``path`` by its present state; row counts by table."""
    counts = {}
    split = {table: table_key(table, keys, small) for table in list_tables(spark, url, login)}
    for table, key in split.items():
        rows = read_table(spark, url, table, login, key, parts)
        counts[table] = replace(stamp(rows), f"{path}/{table}").get["rows"]
    return counts
