"""What a load brought: rows, rejects and last stamp per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.sources.landing import REJECT, STAMP
from caseworks.sources.tables import Table


def load_report(landed: DataFrame, table: str = "table") -> DataFrame:
    """One row per table from one pass; a table that brought no accepted row failed."""
    good = F.col(REJECT).isNull()
    return (
        landed.groupBy(table)
        .agg(
            F.count_if(good).alias("total_records"),
            F.count_if(~good).alias("rejected"),
            F.max(F.when(good, F.col(STAMP))).alias("last_extracted_at"),
        )
        .withColumn("success", F.col("total_records") > 0)
    )


def load_totals(report: DataFrame) -> DataFrame:
    """Tables loaded, tables failed, and rows over all tables."""
    return report.agg(
        F.count_if("success").alias("success"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("total_records").alias("total_records"),
    )


def stream_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed load of a table, from its log alone: no landed row is read again."""
    return Table(spark, path).log().select(
        "load", F.col("rows").alias("total_records"), "rejected", F.col("last_stamp").alias("last_extracted_at"), (F.col("rows") > 0).alias("success")
    )
