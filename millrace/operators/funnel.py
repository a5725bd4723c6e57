"""Conversion funnels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.columns import safe_ratio


def funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], cumulative: bool = False, scale: int = 6) -> DataFrame:
    """Rows per step with the conversion from the previous and from the first step.

    Independent steps each count on their own; a cumulative step also needs all
    steps before it. Either way one pass counts every step.
    """
    tests = [F.coalesce(c, F.lit(False)) for _, c in steps]
    if cumulative:
        tests = [reduce(lambda a, b: a & b, tests[: i + 1]) for i in range(len(tests))]
    one = df.agg(*[F.count_if(t).alias(f"_{i}") for i, t in enumerate(tests)])
    cells = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("name"), F.col(f"_{i}").alias("n")) for i, (n, _) in enumerate(steps)])
    rows = one.select(F.explode(cells).alias("s")).select("s.*")
    # one row per step from here on
    w = Window.orderBy("step")
    prev, first = F.lag("n").over(w), F.first("n").over(w)
    out = rows.withColumns({"_prev": prev, "_first": first})
    at_first = F.col("_prev").isNull()
    return out.select(
        "step",
        "name",
        "n",
        F.when(at_first, F.lit(100.0)).otherwise(F.coalesce(safe_ratio(F.col("n") * 100.0, "_prev", scale), F.lit(100.0))).alias("pct_of_previous"),
        F.coalesce(safe_ratio(F.col("n") * 100.0, "_first", scale), F.lit(0.0)).alias("pct_of_first"),
        F.when(at_first, F.lit(0)).otherwise(F.col("_prev") - F.col("n")).cast("long").alias("dropped"),
        F.when(at_first, F.lit(0.0)).otherwise(F.coalesce(safe_ratio((F.col("_prev") - F.col("n")) * 100.0, "_prev", scale), F.lit(0.0))).alias("dropped_pct"),
    )
