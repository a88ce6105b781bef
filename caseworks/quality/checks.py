"""Data-quality checks. Each returns the violating rows; no rows means the check passes.

``where`` conditions are applied by the caller with ``df.filter`` before a check. Group lists may be
empty; NULL groups form a group. Row-level checks are also given as conditions so that many of them
can share one pass (:mod:`caseworks.quality.suite`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.functions.text import slugify_name
from caseworks.functions.values import as_column, strip
from caseworks.operators.ordered import distinct_with_neighbours, repeat_rows
from caseworks.operators.reshape import columns_except, quoted

Columns = Sequence[str]


# Row-level conditions: true on a violating row, NULL or false elsewhere.


def out_of_range(
    column: Column | str, min_value: Any = None, max_value: Any = None, inclusive: bool = True
) -> Column:
    value, wrong = as_column(column), F.lit(False)
    if min_value is not None:
        wrong = wrong | ~(value >= min_value if inclusive else value > min_value)
    if max_value is not None:
        wrong = wrong | ~(value <= max_value if inclusive else value < max_value)
    return wrong


def is_false(expression: Column | str, column: str | None = None) -> Column:
    """``expression`` as SQL text may start with an operator when a column is named."""
    if isinstance(expression, Column):
        return ~expression
    return ~F.expr(f"`{column}` {expression}" if column else expression)


def is_blank(column: Column | str, trim_whitespace: bool = True) -> Column:
    return (strip(column) if trim_whitespace else as_column(column)) == ""


# Checks.


def accepted_range(
    df: DataFrame, column: str, min_value: Any = None, max_value: Any = None, inclusive: bool = True
) -> DataFrame:
    return df.filter(out_of_range(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: Column | str, column: str | None = None) -> DataFrame:
    return df.filter(is_false(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    value = strip(column) if trim_whitespace else F.col(column)
    return df.select(value.alias(column)).filter(F.col(column) == "")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where both sides are known and differ."""
    return df.filter(F.col(actual) != F.col(expected))


def at_least_one(df: DataFrame, column: str, group_by: Columns = ()) -> DataFrame:
    """Groups without any value. Without groups one found value is enough, so the scan may stop there."""
    if group_by:
        counted = df.groupBy(*group_by).agg(F.count(column).alias("filler_column"))
    else:
        counted = df.select(column).filter(F.col(column).isNotNull()).limit(1).agg(F.count(column).alias("filler_column"))
    return counted.filter("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by: Columns = ()) -> DataFrame:
    """Groups holding exactly one distinct value, found by min = max instead of a distinct count."""
    ends = df.groupBy(*group_by).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return ends.filter("_low = _high").select(*group_by, F.lit(1).cast("bigint").alias("filler_column"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1, group_by: Columns = ()
) -> DataFrame:
    share = (F.count(column) / F.count(F.lit(1))).cast("decimal(38,9)").alias("not_null_proportion")
    low, high = (F.lit(Decimal(str(v))) for v in (at_least, at_most))
    found = F.col("not_null_proportion")
    return df.groupBy(*group_by).agg(share).filter((found < low) | (found > high))


def unique_combination(df: DataFrame, columns: Columns) -> DataFrame:
    keys = [quoted(c) for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")


def unique(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    wrong = df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value_field"))
    return wrong.agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(F.col(column).isin(*values)).select(F.col(column).alias("value_field")).distinct()


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "true", to_condition: str = "true"
) -> DataFrame:
    """Known values without a partner. The partners are made distinct first, so none is hot."""
    ids = df.filter(F.col(column).isNotNull() & F.expr(from_condition)).select(F.col(column).alias("id"))
    partners = to.filter(F.col(field).isNotNull() & F.expr(to_condition)).select(F.col(field).alias("id")).distinct()
    missing = ids.join(partners, "id", "left_anti")
    return missing.withColumn("right_id", F.lit(None).cast(missing.schema["id"].dataType))


def _one_sided(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found on one side only, tagged; both EXCEPTs in one shuffle."""
    tagged = a.withColumn("_in_a", F.lit(True)).unionAll(b.withColumn("_in_a", F.lit(False)))
    keys = [quoted(c) for c in a.columns]
    sides = tagged.groupBy(*keys).agg(F.bool_or("_in_a").alias("_a"), F.bool_and("_in_a").alias("_only_a"))
    side = F.when(F.col("_only_a"), "a_minus_b").when(~F.col("_a"), "b_minus_a")
    return sides.select(side.alias("which_diff"), *keys).filter(F.col("which_diff").isNotNull())


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs found in one of the two columns only."""

    def counted(source: DataFrame, name: str) -> DataFrame:
        return source.groupBy(quoted(name).alias(column)).agg(F.count(F.lit(1)).alias("num_rows"))

    return _one_sided(counted(df, column), counted(to, field)).drop("which_diff")


def equality(
    df: DataFrame,
    other: DataFrame,
    compare_columns: Columns | None = None,
    exclude_columns: Columns | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows of one table that the other lacks, tagged a_minus_b or b_minus_a.

    With ``precision``, decimals and floating numbers are rounded first; whole numbers are left as they are.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    names = list(compare_columns or columns_except(df, exclude_columns or ()))
    if not compare_columns:
        theirs = {c.lower() for c in columns_except(other, exclude_columns or ())}
        if {c.lower() for c in names} != theirs:
            raise ValueError("the tables have different columns; name those to compare or to leave out")

    rounded = (T.DecimalType, T.DoubleType, T.FloatType)

    def side(source: DataFrame) -> DataFrame:
        kinds = {field.name.lower(): field.dataType for field in source.schema}

        def value(name: str) -> Column:
            if precision is None or not isinstance(kinds[name.lower()], rounded):
                return quoted(name).alias(name)
            return F.round(quoted(name).cast("decimal(38,9)"), precision).alias(name)

        return source.select(*[value(c) for c in names])

    return _one_sided(side(df), side(other))


def _row_counts(df: DataFrame, other: DataFrame, group_by: Columns, ours: str, theirs: str) -> DataFrame:
    """Both row counts per group; a group of one side has NULL for the other. NULL groups match none."""
    if not group_by:
        none = F.lit(None).cast("bigint")
        a = df.agg(F.count(F.lit(1)).alias(ours)).withColumn(theirs, none)
        b = other.agg(F.count(F.lit(1)).alias(theirs)).select(none.alias(ours), theirs)
        return a.unionAll(b).agg(F.max(ours).alias(ours), F.max(theirs).alias(theirs))

    def counted(source: DataFrame, mark: str, name: str) -> DataFrame:
        keys = [quoted(c).alias(f"{c}_{mark}") for c in group_by]
        return source.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    a, b = counted(df, "a", ours), counted(other, "b", theirs)
    same = [F.col(f"`{c}_a`") == F.col(f"`{c}_b`") for c in group_by]
    keys = [quoted(f"{c}_{mark}") for c in group_by for mark in ("a", "b")]
    return a.join(b, same, "full").select(*keys, ours, theirs)


def equal_rowcount(df: DataFrame, other: DataFrame, group_by: Columns = ()) -> DataFrame:
    """Every group with its count difference; a group of one side only has none (NULL)."""
    counts = _row_counts(df, other, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by: Columns = ()) -> DataFrame:
    """Every group with its surplus: the excess if we have more rows, 1 if as many, else 0."""
    counts = _row_counts(df, other, group_by, "count_our_model", "count_comparison_model")
    excess = F.col("count_our_model") - F.col("count_comparison_model")
    return counts.withColumn("row_count_delta", F.when(excess > 0, excess).when(excess == 0, 1).otherwise(0))


# How an upper bound must compare with the next lower bound, and the words for it.
GAP_RULES = {
    "not_allowed": ("equal_to", lambda upper, following: upper == following),
    "allowed": ("less_than_or_equal_to", lambda upper, following: upper <= following),
    "required": ("less_than", lambda upper, following: upper < following),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: str,
    upper_bound: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty or reversed, or that clash with the next range of their group."""
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {list(GAP_RULES)}, not {gaps!r}")
    gap_words, gap_holds = GAP_RULES[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    group = ["partition_by_col"] if partition_by else []
    ranges = df.select(
        *([F.expr(partition_by).alias("partition_by_col")] if partition_by else []),
        F.expr(lower_bound).alias("lower_bound"),
        F.expr(upper_bound).alias("upper_bound"),
    )
    lower, upper, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    length_ok, gap_ok = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{gap_words}_next_lower_bound"

    def judged(rows: DataFrame) -> DataFrame:
        length_holds = lower <= upper if zero_length_range_allowed else lower < upper
        marked = rows.withColumns(
            {
                length_ok: F.coalesce(length_holds, F.lit(False)),
                gap_ok: F.coalesce(gap_holds(upper, following), F.col("is_last_record"), F.lit(False)),
            }
        )
        return marked.filter(~(F.col(length_ok) & F.col(gap_ok)))

    distinct = distinct_with_neighbours(ranges, group, ["lower_bound", "upper_bound"])
    columns = [*group, "lower_bound", "upper_bound", "next_lower_bound", "is_last_record"]
    last_copies = distinct.select(
        *group, "lower_bound", "upper_bound",
        F.col("following.lower_bound").alias("next_lower_bound"),
        F.col("following").isNull().alias("is_last_record"),
    )
    # All copies of a range but the last are followed by their own equal.
    other_copies = distinct.filter("copies > 1").select(
        *group, "lower_bound", "upper_bound", lower.alias("next_lower_bound"),
        F.lit(False).alias("is_last_record"), (F.col("copies") - 1).alias("_times"),
    )
    repeated = repeat_rows(judged(other_copies), "_times").drop("_times")
    return judged(last_copies.select(*columns)).unionByName(repeated)


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: Columns = ()
) -> DataFrame:
    """Values that are not the previous one plus the interval; the first of a group passes."""
    before = f"previous_{slugify_name(column)}"
    if datepart:
        expected = F.timestamp_add(datepart.upper(), F.lit(interval), F.col(before))
        breaks = F.col(column).cast("timestamp_ntz") != expected.cast("timestamp_ntz")
    else:
        breaks = F.col(column) != F.col(before) + interval
    distinct = distinct_with_neighbours(df.filter(F.col(column).isNotNull()), list(group_by), [column])
    first_copies = distinct.select(*group_by, column, F.col(f"previous.{column}").alias(before))
    # Further copies of a value follow the value itself.
    other_copies = distinct.filter("copies > 1").select(
        *group_by, column, F.col(column).alias(before), (F.col("copies") - 1).alias("_times")
    )
    repeated = repeat_rows(other_copies.filter(breaks), "_times").drop("_times")
    return first_copies.filter(breaks).unionByName(repeated)


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Columns = (),
    now: dt.datetime | None = None,
) -> DataFrame:
    """Groups whose latest time lies before now minus the interval; an empty table passes."""
    current = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz") if now else F.localtimestamp()
    threshold = F.timestamp_add(datepart.upper(), F.lit(-interval), current)
    latest = F.max(field)
    if ignore_time_component:
        threshold, latest = threshold.cast("date"), latest.cast("date")
    found = df.groupBy(*group_by).agg(latest.alias("most_recent")).withColumn("threshold", threshold)
    return found.filter(F.col("most_recent") < F.col("threshold"))
