"""Column-set and shape operators: star, pivot, unpivot, unions, null cleaning."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.functions.text import slugify_name
from caseworks.functions.values import as_column, empty_to_null

# Fixed value: name of the column that says which table a unioned row came from.
UNION_SOURCE_COLUMN = "_dbt_source_relation"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def columns_except(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    """Column names but the listed ones, compared without regard to case."""
    dropped = {name.lower() for name in without}
    return [c for c in df.columns if c.lower() not in dropped]


def star(df: DataFrame, without: Sequence[str] = (), prefix: str = "", suffix: str = "") -> list[Column]:
    """All columns but some, renamed only when an affix is given."""
    names = columns_except(df, without)
    if not prefix and not suffix:
        return [quoted(c) for c in names]
    return [quoted(c).alias(f"{prefix}{c}{suffix}") for c in names]


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    return df.groupBy(*[quoted(c) for c in df.columns[:n]]).agg(*aggregates)


def null_empty_strings(df: DataFrame) -> DataFrame:
    """Empty strings to NULL in every string column; other columns as they are."""
    return df.select(
        *[empty_to_null(quoted(n)).alias(n) if t == "string" else quoted(n) for n, t in df.dtypes]
    )


COMPARISONS: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
}
AGGREGATES = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}
DISTINCT_AGGREGATES = {"sum": F.sum_distinct, "count": F.count_distinct, "max": F.max, "min": F.min}


def pivot_columns(
    column: Column | str,
    values: Sequence[str],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Any = 1,
    else_value: Any = 0,
    slug_names: bool = False,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate per value for use in ``groupBy(...).agg(*...)``; missing cells get ``else_value``.

    All cells come out of one grouping. ``then_value`` may be a column.
    """
    column = as_column(column)
    aggregate = (DISTINCT_AGGREGATES if distinct else AGGREGATES)[agg]

    def value(v: Any) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    def cell(v: str) -> Column:
        name = f"{prefix}{v}{suffix}"
        picked = F.when(COMPARISONS[cmp](column, F.lit(v)), value(then_value)).otherwise(value(else_value))
        return aggregate(picked).alias(slugify_name(name) if slug_names else name)

    return [cell(v) for v in values]


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Wide to long in one scan: ``exclude`` columns stay beside each row, ``remove`` columns go.

    Every value is cast to one type, booleans by way of 'true'/'false'; NULL values stay.
    """
    names = columns_except(df, [*exclude, *remove])
    kinds = dict(df.dtypes)

    def cast(name: str) -> Column:
        column = quoted(name).cast("string") if kinds[name] == "boolean" else quoted(name)
        return column.cast(cast_to).alias(name)

    kept = [c for e in exclude for c in df.columns if c.lower() == e.lower()]
    narrow = df.select(*[quoted(c) for c in kept], *[cast(c) for c in names])
    return narrow.unpivot([quoted(c) for c in kept], [quoted(c) for c in names], field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = UNION_SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns, in the order first seen.

    A column missing from a table is NULL there; every column has the type it was first seen with,
    or its override. The name of the table comes first in each row unless no column is named for it.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    only, never = {c.lower() for c in include}, {c.lower() for c in exclude}
    kinds: dict[str, str] = {}
    for df in relations.values():
        for name, kind in df.dtypes:
            if name.lower() not in never and (not only or name.lower() in only):
                kinds.setdefault(name, kind)
    if not kinds:
        raise ValueError(f"no columns to union for {', '.join(relations)}")
    kinds |= {name: kind for name, kind in (column_override or {}).items() if name in kinds}

    def branch(name: str, df: DataFrame) -> DataFrame:
        rows = df.filter(where) if where else df
        present = set(df.columns)
        columns = [(quoted(c) if c in present else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]
        tag = [F.lit(name).alias(source_column_name)] if source_column_name else []
        return rows.select(*tag, *columns)

    return reduce(DataFrame.unionAll, [branch(n, df) for n, df in relations.items()])


def matching_tables(spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None) -> list[str]:
    """Catalogue tables whose name fits a LIKE pattern, compared without regard to case.

    With a database, only its own tables count; temporary views belong to none.
    """
    wanted, unwanted = like_pattern(pattern), like_pattern(exclude)
    names = {t.name for t in spark.catalog.listTables(database) if not (database and t.isTemporary)}
    return sorted(name for name in names if wanted.fullmatch(name) and not unwanted.fullmatch(name))


def like_pattern(pattern: str) -> re.Pattern[str]:
    """A LIKE pattern (%, _ and backslash) as a regular expression that ignores case."""
    signs = {"%": ".*", "_": "."}
    parts = re.findall(r"\\.|.", pattern, re.DOTALL)
    return re.compile("".join(signs.get(p) or re.escape(p[-1]) for p in parts), re.IGNORECASE | re.DOTALL)


def union_matching(
    spark: SparkSession,
    pattern: str,
    exclude: str = "",
    database: str | None = None,
    exclude_columns: Sequence[str] = (),
    **options: Any,
) -> DataFrame:
    """:func:`union_relations` over every catalogue table that fits ``pattern`` but not ``exclude``."""
    prefix = f"{database}." if database else ""
    found = matching_tables(spark, pattern, exclude, database)
    tables = {name: spark.table(f"{prefix}`{name}`") for name in found}
    return union_relations(tables, exclude=exclude_columns, **options)


def union_prefixed(spark: SparkSession, prefix: str, exclude: str = "", **options: Any) -> DataFrame:
    """:func:`union_matching` by the start of the name."""
    return union_matching(spark, f"{prefix}%", exclude, **options)
