"""Running totals over a whole ordered table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import pinned


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str = "running", pieces: int | None = None) -> DataFrame:
    """Running sum of ``value`` in a total order of the rows.

    A window without a partition would send all rows to one task. The rows are
    split by range, summed per piece, and each piece's running sum is lifted by
    the sum of the pieces before it. The split is written to shared storage
    first, as two reads of it must agree. As with a window, nulls add nothing and
    the sum is null before the first value.
    """
    n = pieces or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    split = pinned(df.repartitionByRange(n, *order).withColumn("_piece", F.spark_partition_id()))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per piece, whatever the size of the input
    lift = split.groupBy("_piece").agg(F.sum(value).alias("_t")).select("_piece", F.sum("_t").over(before).alias("_lift"))
    inner = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lifted = split.withColumn(out, F.sum(value).over(inner)).join(F.broadcast(lift), "_piece")
    return lifted.withColumn(out, F.coalesce(F.col(out) + F.col("_lift"), out, "_lift")).drop("_piece", "_lift")
