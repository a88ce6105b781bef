"""Row operators: deduplication, number and date rows, frequent values, monthly periods."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseworks.functions.values import as_column


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row per key in the given order; NULL keys form a group like any other.

    Spark keeps one row per key and task already before the shuffle (WindowGroupLimit), so a key
    with very many rows sends only one row per task.
    """
    first = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The numbers 1 to ``upper_bound``, spread over the cluster."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


# Units a spine can step by; each with the number of boundaries crossed between two times.
STEP_UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def _midnight(value: dt.date | dt.datetime) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime(value.year, value.month, value.day)


def intervals_between(start: dt.date | dt.datetime, end: dt.date | dt.datetime, datepart: str) -> int:
    """How many boundaries of the unit lie between two times (weeks start on Sunday)."""
    if datepart not in STEP_UNITS:
        raise ValueError(f"datepart must be one of {STEP_UNITS}, not {datepart!r}")
    first, last = _midnight(start), _midnight(end)
    days = (last.date() - first.date()).days
    if datepart in ("second", "minute", "hour"):
        size = {"second": 1, "minute": 60, "hour": 3600}[datepart]
        origin = dt.datetime(1970, 1, 1)
        return int((last - origin).total_seconds() // size - (first - origin).total_seconds() // size)
    if datepart == "day":
        return days
    if datepart == "week":
        return (last.date().toordinal()) // 7 - (first.date().toordinal()) // 7
    months = (last.year - first.year) * 12 + last.month - first.month
    if datepart == "month":
        return months
    if datepart == "quarter":
        return (last.year * 4 + (last.month - 1) // 3) - (first.year * 4 + (first.month - 1) // 3)
    return last.year - first.year


def date_spine(
    spark: SparkSession, datepart: str, start: dt.date | dt.datetime, end: dt.date | dt.datetime
) -> DataFrame:
    """One row per unit from ``start``, without ``end``; the column is named after the unit."""
    count = intervals_between(start, end, datepart)
    if count <= 0:
        raise ValueError("the end must lie at least one unit after the start")
    number = F.col("generated_number") - 1
    months = {"month": 1, "quarter": 3, "year": 12}.get(datepart)
    if months:
        step = F.make_ym_interval(months=(number * months).cast("int"))
    else:
        seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[datepart]
        step = F.make_dt_interval(days=F.floor(number * seconds / 86400).cast("int"), secs=(number * seconds) % 86400)
    moment = F.lit(_midnight(start).isoformat(sep=" ")).cast("timestamp_ntz") + step
    if not isinstance(start, dt.datetime) and datepart not in ("second", "minute", "hour"):
        moment = moment.cast("date")
    return generate_series(spark, count).select(moment.alias(f"date_{datepart}"))


def column_values(
    df: DataFrame,
    column: Column | str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values, the most frequent first unless another order is given.

    With ``max_records`` Spark keeps the top rows per task and merges them, without a global sort.
    """
    rows = df.filter(where) if where else df
    counted = rows.groupBy(as_column(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.orderBy(*(order_by or [F.desc("n"), F.asc("value")]))
    return ranked.limit(max_records) if max_records is not None else ranked


def column_value_list(
    df: DataFrame | None, column: str, most: int | None = None, default: Sequence | None = None, **options
) -> list:
    """All distinct values as a Python list, for use as pivot columns. NULL is no value.

    With ``most``, more values than that are an error and none is left out. ``default`` stands in for a
    table that does not exist or gives no value.
    """
    if df is None:
        if default is None:
            raise ValueError("no table and no default values")
        return list(default)
    limit = None if most is None else most + 1
    known = df.filter(as_column(column).isNotNull())
    found = [row.value for row in column_values(known, column, max_records=limit, **options).collect()]
    if most is not None and len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return found or list(default or [])


def monthly_periods(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """The rows of ``ranges``, once per calendar month their date range touches.

    ``period_start`` is day 1 of the month, ``period_end`` its last day but never later than ``end``;
    a range that ends before it starts gives no row.
    """
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    months = F.sequence(F.trunc(first, "MM"), last, F.make_ym_interval(months=F.lit(1)))
    per_month = ranges.filter(first <= last).withColumn("period_start", F.explode(months))
    return per_month.withColumn("period_end", F.least(F.last_day("period_start"), last))
