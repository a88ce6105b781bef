"""Outer joins that stay spread out when one key holds a large share of a side.

Adaptive execution splits a hot key on either side of an inner join, but on the outer side only of
a left join and on no side of a full join. These forms keep every hot side where it can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_HASH = -(2**63)


def left_join_hot_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """LEFT JOIN on ``key`` as an inner join plus the left rows without a match.

    Both parts read the same rows and columns of both sides, so each side is built and shuffled once. For that the
    keys are compared null-safe (the right side has no NULL), which filters neither side, and the second part keeps
    the right side's other columns by a hash over both sides that is never less than the least one.
    """
    others = [c for c in right.columns if c != key]
    one, two = left.alias("_left"), right.filter(F.col(f"`{key}`").isNotNull()).alias("_right")
    same = F.col(f"_left.`{key}`").eqNullSafe(F.col(f"_right.`{key}`"))
    matched = one.join(two, same).select("_left.*", *[F.col(f"_right.`{c}`") for c in others])
    any_hash = F.xxhash64(F.col(f"_left.`{key}`"), *[F.col(f"_right.`{c}`") for c in others]) >= F.lit(LEAST_HASH)
    unmatched = one.join(two, same & any_hash, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def full_join_hot_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """FULL JOIN on ``key``, keeping the key of the left side only (NULL on right-only rows)."""
    left_rows = left.join(right, key, "left")
    right_only = right.join(left.select(key).distinct(), key, "left_anti").drop(key)
    return left_rows.unionByName(right_only, allowMissingColumns=True)
