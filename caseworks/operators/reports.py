"""Distributed reports built on the scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.functions.text import url_host, url_parameter, url_path
from caseworks.functions.values import as_column, width_bucket


def histogram(df: DataFrame, value: Column | str, low, high, buckets) -> DataFrame:
    """Row count per bucket of ``value``."""
    return df.groupBy(width_bucket(value, low, high, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def host_traffic(df: DataFrame, url: Column | str) -> DataFrame:
    return df.groupBy(url_host(url).alias("host")).agg(F.count(F.lit(1)).alias("n"))


def path_traffic(df: DataFrame, url: Column | str) -> DataFrame:
    return df.groupBy(url_path(url).alias("path")).agg(F.count(F.lit(1)).alias("n"))


def parameter_traffic(df: DataFrame, url: Column | str, names: list[str]) -> DataFrame:
    """Row count per value of each named URL parameter, all parameters in one scan."""
    url = as_column(url)
    found = F.array(*[F.struct(F.lit(n).alias("parameter"), url_parameter(url, n).alias("value")) for n in names])
    return df.select(F.inline(found)).groupBy("parameter", "value").agg(F.count(F.lit(1)).alias("n"))
