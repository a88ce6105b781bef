"""Scalar column helpers: safe arithmetic, keys, bucketing, distance, empty-string handling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text hashed in place of NULL in a surrogate key.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

# What TRIM strips: ASCII blanks plus the Unicode space separators.
BLANKS = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Both-sided trim of every kind of white space, not only the ASCII blank."""
    return F.btrim(as_column(value), F.lit(BLANKS))


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def _zero_filled(values: Sequence[Column | str], caller: str) -> list[Column]:
    if isinstance(values, (str, Column)) or not isinstance(values, Sequence):
        raise TypeError(f"{caller} takes one list of columns")
    return [F.coalesce(as_column(v), F.lit(0)) for v in values]


def safe_add(values: Sequence[Column | str]) -> Column:
    """Sum of the columns, NULL counting as 0."""
    return reduce(add, _zero_filled(values, "safe_add"))


def safe_subtract(values: Sequence[Column | str]) -> Column:
    """First column minus the others, NULL counting as 0."""
    return reduce(sub, _zero_filled(values, "safe_subtract"))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL where the denominator is 0 or either side is NULL."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def surrogate_key(columns: Sequence[Column | str], null_as_empty: bool = False) -> Column:
    """md5 over the columns as text joined with '-'; NULL hashes as a fixed token (or as '')."""
    filler = F.lit("" if null_as_empty else NULL_KEY_TOKEN)
    texts = [F.coalesce(as_column(c).cast("string"), filler) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def width_bucket(value: Column | str, low: Column | float, high: Column | float, buckets: Column | int) -> Column:
    """Bucket number by ceiling, one more when the value is a whole multiple of the bin width.

    Values above ``high`` go to ``buckets + 1`` before that correction,
    so this differs from Spark's ``width_bucket`` on multiples of the width outside the range.
    """
    x = as_column(value)
    lo, hi, n = (v if isinstance(v, Column) else F.lit(v) for v in (low, high, buckets))
    width = (hi - lo) / n
    numeric = "decimal(38,9)"
    on_edge = F.when(F.try_mod(x.try_cast(numeric), width.try_cast(numeric)) == 0, 1).otherwise(0)
    return on_edge + F.least(F.ceil((x - lo) / width), (n + 1).cast("bigint"))


def great_circle_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Haversine distance in miles or kilometres between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    phi1, lam1, phi2, lam2 = (F.radians(as_column(c)) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((phi2 - phi1) / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((lam2 - lam1) / 2), 2)
    return 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(half_chord)) * (1 if unit == "mi" else KM_PER_MILE)
