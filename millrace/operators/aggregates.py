"""Grouped aggregation. Null keys are dropped where the result is a labelled series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import safe_ratio
from millrace.operators.joins import densify
from millrace.operators.quantiles import quantile_columns


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present."""
    return df.na.drop(subset=list(keys)) if keys else df


def group_mean(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean", scale: int | None = 6) -> DataFrame:
    mean = F.avg(value)
    return with_keys(df, keys).groupBy(*keys).agg((F.bround(mean, scale) if scale is not None else mean).alias(out))


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str = "total", scale: int | None = 2) -> DataFrame:
    total = F.sum(value)
    return with_keys(df, keys).groupBy(*keys).agg((F.bround(total, scale) if scale is not None else total).alias(out))


def group_agg(df: DataFrame, keys: Sequence[str], specs: Mapping[str, Column]) -> DataFrame:
    """Named aggregates in one pass."""
    return with_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in specs.items()])


def group_summary(df: DataFrame, keys: Sequence[str], value: str, scale: int = 6) -> DataFrame:
    """Count, mean, median, standard deviation, minimum and maximum per group."""
    base = with_keys(df, keys)
    moments = base.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.bround(F.avg(value), scale).alias("mean"),
        F.bround(F.stddev_samp(value), scale).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return moments.join(quantile_columns(base, value, {"median": 0.5}, keys, scale), list(keys), "left")


def flag_counts(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], total: str = "total") -> DataFrame:
    """Rows per group on which each flag holds, and all rows."""
    specs = {n: F.count_if(F.coalesce(c, F.lit(False))) for n, c in flags.items()}
    return group_agg(df, keys, {**specs, total: F.count(F.lit(1))})


def five_number(df: DataFrame, keys: Sequence[str], value: str, scale: int = 6) -> DataFrame:
    """Minimum, quartiles and maximum per group, linearly interpolated."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return quantile_columns(with_keys(df, keys), value, probs, keys, scale)


def group_median(df: DataFrame, keys: Sequence[str], values: Sequence[str], scale: int = 6) -> DataFrame:
    """Median of several columns per group, all found in the same passes."""
    base = with_keys(df, keys).select(*keys, *[F.col(v).cast("double").alias(v) for v in values])
    found = quantile_columns(base.unpivot(list(keys), list(values), "_column", "_value"), "_value", {"_median": 0.5}, [*keys, "_column"], scale)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_column") == v, F.col("_median"))).alias(v) for v in values])
    # a group without any value is a group all the same
    return base.select(*keys).distinct().join(wide, list(keys), "left")


def group_mode(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties.

    Counted per (group, value) first, so no group's values are held in one buffer.
    """
    counts = with_keys(df, [*keys, value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct(-F.col("_n"), F.col(value).alias("_v"))).alias("_b"))
    return best.select(*keys, F.col("_b._v").alias(out))


def group_first(df: DataFrame, key: str, value: str, order: Column, out: str = "first") -> DataFrame:
    """First non-null value per key in the given order."""
    return with_keys(df, [key]).where(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, order).alias(out))


def value_counts(df: DataFrame, column: str, n: int | None = None, dropna: bool = True, share: bool = False, scale: int = 6) -> DataFrame:
    """Rows per value, most frequent first, smaller value first on ties."""
    base = with_keys(df, [column]) if dropna else df
    counts = base.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if share:
        counts = counts.withColumn("pct", F.bround(F.col("n") * 100.0 / base.agg(F.count(F.lit(1))).scalar(), scale))
    ordered = counts.orderBy(F.desc("n"), F.asc(column))
    return ordered if n is None else ordered.limit(n)


def share(df: DataFrame, key: str, value: str, out: str = "pct", scale: int = 6) -> DataFrame:
    """Each row's part of the column total, in percent."""
    total = df.agg(F.sum(value)).scalar()
    return df.select(key, value, F.bround(safe_ratio(F.col(value) * 100.0, total), scale).alias(out))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], value: str, label: str, scale: int = 6) -> DataFrame:
    """Count, sum and mean at several grouping levels stacked; a rolled-up key shows ``label``.

    Rows are first reduced to the finest level, and only that small table is
    expanded into the sets; means come from sums and counts.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    fine = df.groupBy(*keys).agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))
    levels = fine.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), *[F.grouping(k).alias(f"_g_{k}") for k in keys]
    )
    shown = [F.when(F.col(f"_g_{k}") == 1, F.lit(label)).otherwise(F.col(k).cast("string")).alias(k) for k in keys]
    return levels.select(*shown, F.col("_n").alias("n"), F.bround(safe_ratio("_s", "_n"), scale).alias("mean"))


def kpis(df: DataFrame, target: Column, value: str, scale: int = 6) -> DataFrame:
    """One row: rows, positives, conversion percentage and mean of a value."""
    n, hits = F.count(F.lit(1)), F.count_if(F.coalesce(target, F.lit(False)))
    return df.agg(
        n.alias("n"),
        hits.alias("positives"),
        F.coalesce(safe_ratio(hits * 100.0, n, scale), F.lit(0.0)).alias("conversion_pct"),
        F.bround(F.avg(value), scale).alias("mean_value"),
    )


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy("column").agg(
        F.sum("_n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("_n")).alias("neg"), F.col("value"))).alias("_b"),
    )
    return best.select("column", "count", "unique", F.col("_b.value").alias("top"), (-F.col("_b.neg")).alias("freq"))


def duplicate_report(df: DataFrame, keysets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per key set: rows, rows in duplicate groups, and rows too many."""

    def audit(name: str, keys: Sequence[str]) -> DataFrame:
        n = F.col("_n")
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.lit(name).alias("key_set"),
            F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(n > 1, n).otherwise(0)), F.lit(0)).alias("duplicate_rows"),
            F.coalesce(F.sum(n - 1), F.lit(0)).alias("surplus_rows"),
        )

    return reduce(lambda a, b: a.unionByName(b), [audit(n, k) for n, k in keysets.items()])


def duplicate_samples(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The ``n`` largest duplicate groups."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.orderBy(F.desc("n"), *keys).limit(n)


def null_report(df: DataFrame, columns: Sequence[str] | None = None, scale: int = 6) -> DataFrame:
    """Null count and percentage per column, from one pass."""
    cols = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["_rows"], cols, "column", "nulls")
    return long.select("column", "nulls", F.col("_rows").alias("rows"), safe_ratio(F.col("nulls") * 100.0, "_rows", scale).alias("null_pct"))


def ratio_of_sums(df: DataFrame, keys: Sequence[str], num: str, den: str, out: str = "ratio", scale: int = 6) -> DataFrame:
    """Sum over sum per group, null over a zero sum; not the mean of the ratios."""
    return with_keys(df, keys).groupBy(*keys).agg(safe_ratio(F.sum(num), F.sum(den), scale).alias(out))


def daily_counts(df: DataFrame, ts: str, key: str) -> DataFrame:
    return with_keys(df, [key]).groupBy(F.col(ts).cast("date").alias("day"), key).agg(F.count(F.lit(1)).alias("n"))


def mean_of_means(df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str, out: str = "mean", scale: int = 6) -> DataFrame:
    """Mean of the inner groups' means; every inner group counts alike."""
    first = with_keys(df, inner).groupBy(*inner).agg(F.avg(value).alias("_m"))
    return first.groupBy(*outer).agg(F.bround(F.avg("_m"), scale).alias(out))


def compare_by_flag(df: DataFrame, flag: Column, values: Sequence[str], name: str = "flag", scale: int = 6) -> DataFrame:
    """Mean of each value and row count with and without the flag."""
    return df.groupBy(flag.alias(name)).agg(F.count(F.lit(1)).alias("n"), *[F.bround(F.avg(v), scale).alias(f"avg_{v}") for v in values])


def source_matrix(sources: Mapping[str, DataFrame], key: str, keys: Sequence) -> DataFrame:
    """Rows per key and source, zero-filled over the listed keys and all sources."""
    parts = [df.select(key).withColumn("source", F.lit(s)) for s, df in sources.items()]
    counts = reduce(lambda a, b: a.unionByName(b), parts).groupBy(key, "source").agg(F.count(F.lit(1)).alias("n"))
    return densify(counts, [key, "source"], {"n": 0}, {key: list(keys), "source": list(sources)})


def join_labels(df: DataFrame, keys: Sequence[str], label: str, sep: str = ",", out: str = "labels") -> DataFrame:
    """The distinct labels of a group joined in order.

    Copies are removed before anything is gathered, so the text is as long as
    the label vocabulary, however many rows the group has.
    """
    unique = with_keys(df, [*keys, label]).select(*keys, label).distinct()
    return unique.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(label)), sep).alias(out))
