"""Running checks: thresholds, severities and one-pass evaluation of row-level checks.

:mod:`caseworks.quality.fused` runs grouped checks of one table from one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def summed(column: str) -> Column:
    """Failures of the row-count checks: the sum of their differences."""
    return F.sum(F.coalesce(F.col(column), F.lit(0)))


def equality_failures() -> Column:
    """Failures of an equality check: its rows plus the imbalance of the two sides."""
    side = F.when(F.col("which_diff") == "a_minus_b", 1).when(F.col("which_diff") == "b_minus_a", -1)
    return F.count(F.lit(1)) + F.coalesce(F.abs(F.sum(side)), F.lit(0))


@dataclass(frozen=True)
class Check:
    """Violations with the rule that turns them into a number and the thresholds on that number."""

    name: str
    violations: DataFrame
    failures: Column = field(default_factory=row_count)
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    severity: str = "error"

    @classmethod
    def on(
        cls, name: str, df: DataFrame, build: Callable[[DataFrame], DataFrame], where: Column | str | None = None, **rules: Any
    ) -> Check:
        """A check of a table, or of those of its rows that meet ``where``."""
        return cls(name, build(df if where is None else df.filter(where)), **rules)


def status_of(warn_if: str, error_if: str, severity: str, failures: str = "failures") -> Column:
    """What the thresholds say on the number in the column ``failures``."""
    warned = F.when(F.expr(f"{failures} {warn_if}"), "warn").otherwise("pass")
    return F.when(F.expr(f"{failures} {error_if}"), "error").otherwise(warned) if severity == "error" else warned


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One (check, failures, status) row per check."""

    def result(check: Check) -> DataFrame:
        counted = check.violations.agg(F.coalesce(check.failures, F.lit(0)).cast("bigint").alias("failures"))
        status = status_of(check.warn_if, check.error_if, check.severity).alias("status")
        return counted.select(F.lit(check.name).alias("check"), "failures", status)

    return reduce(DataFrame.unionAll, [result(c) for c in checks])


def run_row_checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One (check, failures, status) row per condition, all from a single scan of the table."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    pairs = [F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failures")) for n in conditions]
    status = F.when(F.col("failures") != 0, "error").otherwise("pass").alias("status")
    return counts.select(F.inline(F.array(*pairs))).select("check", "failures", status)
