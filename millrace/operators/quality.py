"""Checks between stages of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of two stages and whether they agree."""
    a = before.agg(F.count(F.lit(1))).scalar()
    counts = after.agg(F.count(F.lit(1)).alias("rows_after")).withColumn("rows_before", a)
    return counts.select("rows_before", "rows_after", (F.col("rows_before") == F.col("rows_after")).alias("equal"))


def tag_totals(df: DataFrame, tag: str, none: str) -> DataFrame:
    """Rows per tag, untagged rows left out."""
    return df.where(F.col(tag).isNotNull() & (F.col(tag) != none)).groupBy(tag).agg(F.count(F.lit(1)).alias("n"))
