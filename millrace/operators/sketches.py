"""Quantiles, distinct and frequent values by sketches that add up.

The exact operators are the default; these are for tables whose profile is wanted
in one pass, or day by day. Sketches of one day are rows of a table: days are
merged without reading their rows again, and every group is combined before the
shuffle, so a hot group costs one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Sizes: entries of a quantile sketch, bits of a distinct count's buckets, values tracked as frequent.
RANKS, BUCKET_BITS, TRACKED = 2000, 14, 3000


def rank_error(ranks: int = RANKS) -> float:
    """By how much of the rows a quantile's rank is off, with a confidence of 99 %."""
    return 2.296 / ranks**0.9021  # fixed values: the measured error of the sketch that Spark uses


def distinct_error(bits: int = BUCKET_BITS) -> float:
    """By how much of itself a distinct count is off, three standard deviations."""
    return 3 * 1.04 / 2 ** (bits / 2)


def frequency_error(tracked: int = TRACKED) -> float:
    """By how much of the rows a value's frequency is off at most; rarer values may be missing."""
    return 3.5 / tracked


def sketched(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), by: Sequence[str] = (), ranks: int = RANKS, bits: int = BUCKET_BITS, tracked: int = TRACKED) -> DataFrame:
    """One row per group and column: rows, nulls, range, sum, and three sketches. One pass.

    Null keys are a group. NaN counts as null; -0.0 and 0.0 are one value. A column
    without values has empty sketches; an empty table has no groups, or without
    ``by`` one row per column.
    """

    def one(c: str) -> Column:
        is_number = c in numeric
        v = F.col(f"`{c}`").cast("double") + 0.0 if is_number else F.lit(None).cast("double")
        v = F.when(~F.isnan(v), v)
        name = v.cast("string") if is_number else F.col(f"`{c}`").cast("string")
        return F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(name.isNull()).alias("nulls"), F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).alias("sum"),
            F.kll_sketch_agg_double(v, F.lit(ranks)).alias("quantiles"), F.hll_sketch_agg(name, F.lit(bits)).alias("distinct"),
            F.call_function("approx_top_k_accumulate", name, F.lit(tracked)).alias("frequent"),
        )

    rows = df.groupBy(*by).agg(F.array(*map(one, [*numeric, *categorical])).alias("_s"))
    return rows.select(*by, F.explode("_s").alias("_s")).select(*by, "_s.*")


def merged(sketches: DataFrame, by: Sequence[str] = (), ranks: int = RANKS, tracked: int = TRACKED) -> DataFrame:
    """Sketches of many groups, days or files as those of fewer, by ``by`` and column."""
    return sketches.groupBy(*by, "column").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls")], F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"),
        F.kll_merge_agg_double("quantiles", F.lit(ranks)).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"),
    )


def estimates(sketches: DataFrame, by: Sequence[str] = (), probs: dict[str, float] | None = None, scale: int = 6) -> DataFrame:
    """What sketches say: rows, nulls, range and mean are exact, the rest within the stated errors.

    A quantile is a value that occurs, not one between two. ``top`` is null where
    no value is frequent enough to be told.
    """
    probs = probs or {"q1": 0.25, "median": 0.5, "q3": 0.75}
    some = F.col("min").isNotNull()
    # null is counted among the values
    two = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(2))
    top = F.get(F.filter(two, lambda x: x["item"].isNotNull()), F.lit(0))
    return sketches.select(
        *by, "column", "rows", "nulls", "min", "max", F.bround(F.col("sum") / F.when(some, F.col("rows") - F.col("nulls")), scale).alias("mean"),
        *[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(n) for n, p in probs.items()],
        F.hll_sketch_estimate("distinct").alias("distinct"), top["item"].alias("top"), top["count"].alias("freq"),
    )


def profile_sketched(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], **sizes: int) -> DataFrame:
    """Every column's nulls, range, mean, quartiles, distinct and top value by one pass over the rows."""
    return estimates(sketched(df, numeric, categorical, **sizes))
