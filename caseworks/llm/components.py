"""Connected components of links that may be long chains or huge stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.llm.support import in_parts, settled


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of the links (a, b).

    Large-star and small-star steps alternate until nothing changes. Each keeps one row per link and takes a
    minimum per node, so a node with very many links is pre-aggregated and its joins can be split; the number
    of steps grows with the logarithm of the longest chain. No links give no rows.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    )
    state = None
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
        edges = in_parts(edges, seen.n)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = in_parts(in_parts(large, seen.n).distinct(), seen.n)
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")
        )
        small = in_parts(small.select("e.u", "e.v").filter("u != v"), seen.n).distinct()
        edges = settled(in_parts(small, seen.n))
    # Every node now points at its root, and roots at nothing.
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
