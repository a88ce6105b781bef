"""Neighbour values in one global order, without a single-task window.

``lag``/``lead`` over a whole table, or over a group that holds much of it, would run in one task.
Here the distinct keys are dealt into ranges, neighbours are looked up inside each range, and only
the edges of each range are passed on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COPIES_PER_BLOCK = 100_000
# The order is cut at some of a fixed sample of so many keys; a power of two.
SAMPLE = 1 << 14
# About so many rows make a range, or more, once all keys of the sample are cuts.
RANGE_ROWS = 25_000


def _ranged(distinct: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``distinct`` with the struct ``_key`` and the number of its range, ``_range``.

    The sample are the ``SAMPLE`` keys with the smallest hashes, so the cuts follow from the data alone and two reads
    of the plan agree on them. Every n-th key of it is a cut, so that ranges are even and as many as the rows ask for.
    Cuts are one row, sent to every task, and nothing runs before the result is asked for. A row finds its range by
    bisection, in as many steps as the cuts need.
    """
    key = F.struct(*[F.col(k) for k in keys])
    sample = distinct.select(key.alias("_key")).orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE)
    total = distinct.agg(F.count(F.lit(1))).scalar()
    every = F.greatest(F.lit(1), F.floor(F.size("_all") * F.lit(RANGE_ROWS) / total))
    cuts = sample.agg(F.array_sort(F.collect_list("_key")).alias("_all")).select("_all", every.alias("_every"))
    cuts = cuts.select(F.filter("_all", lambda _, i: (i + 1) % F.col("_every") == 0).alias("_cuts"))
    steps = F.array(*[F.lit(SAMPLE >> i) for i in range(SAMPLE.bit_length())])
    cuts = cuts.select("_cuts", F.filter(steps, lambda step: step <= F.size("_cuts")).alias("_steps"))

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("_cuts", at + step - 1) <= key, at + step).otherwise(at)

    place = F.aggregate("_steps", F.lit(0), further)
    return distinct.join(F.broadcast(cuts)).select(*distinct.columns, key.alias("_key"), place.alias("_range"))


def distinct_with_neighbours(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Distinct (group, order) rows with ``copies`` and the structs ``previous`` and ``following``.

    ``previous``/``following`` hold the order columns of the neighbouring distinct row of the same
    group, NULL at its ends. NULLs sort first and NULL groups equal each other. Equal rows are counted
    before the shuffle, so a single value with very many rows is one row here.
    """
    keys = [*group_by, *order_by]
    distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    rows = _ranged(distinct, keys)
    edges = rows.groupBy("_range").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high"))
    # One row per range, so a window over all of them stays small.
    in_order = Window.orderBy("_range")
    edges = edges.select(
        "_range", F.lag("_high").over(in_order).alias("_before"), F.lead("_low").over(in_order).alias("_after")
    )
    in_range = Window.partitionBy("_range").orderBy(*keys)
    near = rows.withColumns({"_lag": F.lag("_key").over(in_range), "_lead": F.lead("_key").over(in_range)})
    joined = near.join(F.broadcast(edges), "_range")

    def neighbour(inside: str, outside: str):
        key = F.coalesce(inside, outside)
        same = F.lit(True)
        for name in group_by:
            same = same & key[name].eqNullSafe(F.col(name))
        return F.when(key.isNotNull() & same, F.struct(*[key[name].alias(name) for name in order_by]))

    return joined.select(
        *keys, "copies", neighbour("_lag", "_before").alias("previous"), neighbour("_lead", "_after").alias("following")
    )


def repeat_rows(df: DataFrame, times: str, block: int = COPIES_PER_BLOCK) -> DataFrame:
    """Each row ``times`` times. Copies are made in blocks that are dealt out first, so that a row with
    very many copies is not repeated by one task."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(times) - 1, F.lit(block).cast("bigint"))
    blocks = (
        df.filter(F.col(times) > 0)
        .withColumn("_start", F.explode(starts))
        .withColumn("_size", F.least(F.lit(block).cast("bigint"), F.col(times) - F.col("_start")))
        .repartition("_start", *df.columns)
    )
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size")))
    return blocks.withColumn("_copy", copy).select(*df.columns)
