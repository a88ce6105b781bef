"""The most frequent values of a column with very many distinct ones, exactly and without shuffling them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.values import as_column

BUCKETS = 1 << 16


def most_frequent(
    df: DataFrame, column: Column | str, most: int, where: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The ``most`` values with the most rows, as ``value`` and ``n``; equal counts by ascending value. NULL is a value.

    1. Rows are counted per hash bucket of their value: a task sends one row per bucket, however many values it holds.
    2. The values of the fullest buckets are counted exactly. The count of the last of the best ``most`` of them is a
       bound: at least that many values reach it.
    3. A value has no more rows than its bucket, so buckets below the bound are out. The values of the others are
       counted exactly.

    Where the bound is above the rows of a usual bucket, almost all distinct values stay out of the shuffle. On even data
    no bucket is below it, and the last step is the full count. The result is the same in both cases. Only bucket
    numbers, at most ``buckets``, are broadcast. The table is read three times.
    """
    if most < 1:
        raise ValueError("ask for one value at least")
    rows = (df.filter(where) if where else df).select(as_column(column).alias("value"))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    loads = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    ranking = [F.desc("n"), F.asc("value")]

    def best(chosen: DataFrame) -> DataFrame:
        inside = rows.join(F.broadcast(chosen.select("_bucket")), "_bucket", "left_semi")
        return inside.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(*ranking).limit(most)

    fullest = loads.orderBy(F.desc("_rows"), "_bucket").limit(min(4 * most, buckets))
    reached = F.when(F.count(F.lit(1)) == most, F.min("n")).otherwise(F.lit(0))
    bound = best(fullest).agg(reached.alias("_bound"))
    return best(loads.filter(F.col("_rows") >= bound.scalar()))
