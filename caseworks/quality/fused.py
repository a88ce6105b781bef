"""Many checks of one table from one scan.

Rules with equal group keys share one grouping, and all groupings share one scan and one shuffle of their groups. Rows
are reduced per group and task before that shuffle, so a hot group sends one row per task. The rows are dealt out evenly
first: a task that met many rows of nearly unique groups would spill them. Rules without groups and rules on single rows
are read off the empty grouping. A rule counts like the check of the same name in
:mod:`caseworks.quality.checks`: groups that violate it, or rows for :func:`holds`. NULL keys form a group.

``where`` is SQL text and limits a rule to part of the table; a group without such a row does not exist for it. On a
table without rows a rule without groups sees no value at all: ``at_least_one`` fails, the others pass.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from caseworks.quality.suite import status_of

# How a part is gathered from rows, and how parts of the same groups are put together.
GATHER = {"count": F.count_if, "min": F.min, "max": F.max}
MERGE = {"count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Rule:
    """Parts (kind, SQL text) gathered per group, and the condition on them that marks a violation.

    Without ``violated`` the rule's one part counts violating rows. A rule can be made without a session.
    """

    name: str
    parts: tuple[tuple[str, str], ...]
    violated: Callable[..., Column] | None = None
    group_by: tuple[str, ...] = ()
    where: str | None = None
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    severity: str = "error"

    def limited(self) -> list[tuple[str, str]]:
        """The parts on the rows that ``where`` leaves, the number of these rows last."""
        wanted = [*self.parts, ("count", "true")]
        if self.where is None:
            return wanted
        return [
            (kind, f"({self.where}) AND ({text})" if kind == "count" else f"CASE WHEN {self.where} THEN {text} END")
            for kind, text in wanted
        ]


def _known(column: str) -> tuple[str, str]:
    return "count", f"`{column}` IS NOT NULL"


def holds(name: str, expression: str, **rule) -> Rule:
    """Rows where the expression is false; NULL passes."""
    return Rule(name, (("count", f"NOT ({expression})"),), **rule)


def not_null(name: str, column: str, **rule) -> Rule:
    return Rule(name, (("count", f"`{column}` IS NULL"),), **rule)


def at_least_one(name: str, column: str, group_by: Sequence[str] = (), **rule) -> Rule:
    return Rule(name, (_known(column),), lambda known: known == 0, tuple(group_by), **rule)


def not_constant(name: str, column: str, group_by: Sequence[str] = (), **rule) -> Rule:
    ends = (("min", f"`{column}`"), ("max", f"`{column}`"))
    return Rule(name, ends, lambda low, high: low == high, tuple(group_by), **rule)


def not_null_proportion(
    name: str, column: str, at_least: float, at_most: float = 1, group_by: Sequence[str] = (), **rule
) -> Rule:
    def violated(known: Column, rows: Column) -> Column:
        low, high = (F.lit(Decimal(str(v))) for v in (at_least, at_most))
        share = F.try_divide(known, rows).cast("decimal(38,9)")
        return (share < low) | (share > high)

    parts = (_known(column), ("count", "true"))
    return Rule(name, parts, violated, tuple(group_by), **rule)


def unique_combination(name: str, columns: Sequence[str], **rule) -> Rule:
    return Rule(name, (("count", "true"),), lambda rows: rows > 1, tuple(columns), **rule)


def unique(name: str, column: str, where: str | None = None, **rule) -> Rule:
    known = f"`{column}` IS NOT NULL"
    return unique_combination(name, [column], where=f"({where}) AND {known}" if where else known, **rule)


def recency(
    name: str, field: str, datepart: str, interval: int, group_by: Sequence[str] = (), now: dt.datetime | None = None, **rule
) -> Rule:
    def violated(latest: Column) -> Column:
        current = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz") if now else F.localtimestamp()
        return latest < F.timestamp_add(datepart.upper(), F.lit(-interval), current)

    return Rule(name, (("max", f"`{field}`"),), violated, tuple(group_by), **rule)


def _keys(rule: Rule) -> tuple[str, ...]:
    return tuple(sorted(set(rule.group_by)))


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One (check, failures, status) row per rule."""
    if not rules:
        raise ValueError("no rules")
    # The same columns in another order are the same groups.
    groupings = list(dict.fromkeys(_keys(rule) for rule in rules))
    wanted = {g: list(dict.fromkeys(p for rule in rules if _keys(rule) == g for p in rule.limited())) for g in groupings}
    texts = [text for parts in wanted.values() for _, text in parts]
    kinds = dict(zip(texts, (f.dataType for f in df.select(*[F.expr(text) for text in texts]).schema)))
    key_kinds = {key: df.select(f"`{key}`").schema[0].dataType for grouping in groupings for key in grouping}

    # Groupings put their keys and parts into the same columns, by type, so that no row carries what others gather.
    places: dict[tuple[tuple[str, ...], Any], str] = {}
    slots: dict[str, tuple[str, DataType]] = {}
    names: dict[tuple[str, DataType, int], str] = {}
    for g in groupings:
        used: Counter = Counter()
        members = [(key, "key", key_kinds[key]) for key in g] + [(part, part[0], kinds[part[1]]) for part in wanted[g]]
        for member, role, kind in members:
            name = names.setdefault((role, kind, used[role, kind]), f"_{role}{len(names)}")
            used[role, kind] += 1
            slots[name], places[g, member] = (role, kind), name

    def row_of(number: int, grouping: tuple[str, ...]) -> Column:
        filled = {places[grouping, key]: F.col(f"`{key}`") for key in grouping}
        filled |= {places[grouping, part]: F.expr(part[1]) for part in wanted[grouping]}
        empty = {name: F.lit(None).cast(kind) for name, (_, kind) in slots.items()}
        return F.struct(F.lit(number).alias("_grouping"), *[c.alias(name) for name, c in (empty | filled).items()])

    # Tasks of even size before the groups are gathered: what a task gathers fits its memory, on tables of any size.
    rows = df.hint("rebalance") if key_kinds else df
    rows = rows.select(F.inline(F.array(*[row_of(i, g) for i, g in enumerate(groupings)])))
    gathered = [GATHER[role](name).alias(name) for name, (role, _) in slots.items() if role != "key"]
    grouped = rows.groupBy("_grouping", *[name for name, (role, _) in slots.items() if role == "key"]).agg(*gathered)

    def own(rule: Rule) -> Column:
        return F.col("_grouping") == groupings.index(_keys(rule))

    # Counts of violating groups, and the parts of the whole table; exactly one row, also for an empty table.
    totals: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        *found, seen = [places[_keys(rule), p] for p in rule.limited()]
        if rule.group_by:
            totals[f"_n{i}"] = F.count_if(own(rule) & (F.col(seen) > 0) & rule.violated(*map(F.col, found)))
            continue
        for (kind, _), column in zip(rule.parts, found):
            merged = MERGE[kind](F.when(own(rule), F.col(column)))
            totals[f"_all{column}"] = F.coalesce(merged, F.lit(0)) if kind == "count" else merged
    whole = grouped.agg(*[column.alias(name) for name, column in totals.items()])

    def failures(i: int, rule: Rule) -> Column:
        if rule.group_by:
            return F.col(f"_n{i}")
        found = [F.col(f"_all{places[(), p]}") for p in rule.limited()[:-1]]
        return F.when(rule.violated(*found), 1).otherwise(0) if rule.violated else found[0]

    counted = whole.select(*[failures(i, rule).cast("bigint").alias(f"_f{i}") for i, rule in enumerate(rules)])
    results = [
        F.struct(
            F.lit(rule.name).alias("check"),
            F.col(f"_f{i}").alias("failures"),
            status_of(rule.warn_if, rule.error_if, rule.severity, f"_f{i}").alias("status"),
        )
        for i, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*results)))
