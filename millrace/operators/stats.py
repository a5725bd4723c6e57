"""Descriptive statistics and significance tests."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import safe_ratio
from millrace.functions.pvalues import chi2_pvalue, t_pvalue
from millrace.operators.aggregates import describe_categorical, group_mode, with_keys
from millrace.operators.joins import salted_join
from millrace.operators.quantiles import quantile_columns, quantiles
from millrace.session import pinned

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Numeric columns as (column, value) rows; adding 0.0 turns -0.0 into 0.0."""
    cols = [(F.col(c).cast("double") + 0.0).alias(c) for c in columns]
    return df.select(*keys, *cols).unpivot(list(keys), list(columns), "column", "value")


def describe_numeric(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), scale: int = 6) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column (and key)."""
    rows = with_keys(df, keys).select(*keys, *[(F.col(c).cast("double") + 0.0).alias(c) for c in columns])

    def numbers(c: str) -> list[Column]:
        return [
            F.count(c).alias("n"),
            F.bround(F.avg(c), scale).alias("mean"),
            F.bround(F.stddev_samp(c), scale).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        ]

    one = rows.groupBy(*keys).agg(*[F.struct(F.lit(c).alias("column"), *numbers(c)).alias(c) for c in columns])
    base = one.select(*keys, F.explode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("_s")).select(*keys, "_s.*")
    by = [*keys, "column"]
    return base.join(quantile_columns(long_form(rows, columns, keys), "value", QUARTILES, by, scale), by, "left")


def describe_by(df: DataFrame, target: str, columns: Sequence[str], scale: int = 6) -> DataFrame:
    return describe_numeric(df, columns, [target], scale)


def sample_skew(value: Column | str) -> Column:
    """Adjusted skewness G1; null below three values."""
    n, g = F.count(value).cast("double"), F.skewness(value)
    return F.when(n > 2, g * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def sample_kurtosis(value: Column | str) -> Column:
    """Adjusted excess kurtosis G2; null below four values."""
    n, g = F.count(value).cast("double"), F.kurtosis(value)
    return F.when(n > 3, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g + 6))


def _moments(value: str, kind: str, scale: int) -> list[Column]:
    if kind not in ("population", "sample"):
        raise ValueError(kind)
    std = F.stddev_pop(value) if kind == "population" else F.stddev_samp(value)
    skew = F.skewness(value) if kind == "population" else sample_skew(value)
    kurt = F.kurtosis(value) if kind == "population" else sample_kurtosis(value)
    rounded = {"mean": F.avg(value), "std": std, "skew": skew, "kurtosis": kurt, "cv": safe_ratio(std, F.avg(value))}
    return [F.count(value).alias("n"), *[F.bround(c, scale).alias(n) for n, c in rounded.items()]]


def moments(df: DataFrame, value: str, keys: Sequence[str] = (), kind: str = "population", scale: int = 6) -> DataFrame:
    """Mean, deviation, skewness, excess kurtosis and coefficient of variation.

    ``population`` divides by n; ``sample`` uses the adjusted estimators.
    """
    base, aggs = with_keys(df, keys), _moments(value, kind, scale)
    return base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)


def _with_fences(base: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """All rows next to their group's quartiles and fences, and the flag ``_out``.

    The fences are one row per group; a hot group's rows are dealt to many tasks.
    """
    q = quantile_columns(base, value, QUARTILES, keys, None)
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumns({"iqr": iqr, "lower_fence": F.col("q1") - 1.5 * iqr, "upper_fence": F.col("q3") + 1.5 * iqr})
    joined = salted_join(base.select(*keys, value), fences, keys, value)
    return joined.withColumn("_out", (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence")))


def advanced_stats(df: DataFrame, value: str, keys: Sequence[str], scale: int = 6) -> DataFrame:
    """Moments, mode, quartiles, fences and number of outliers per group."""
    base = with_keys(df, keys).where(F.col(value).isNotNull())
    same = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"]
    numbers = _with_fences(base, value, keys).groupBy(*keys).agg(
        *_moments(value, "sample", scale),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        *[F.bround(F.max(c), scale).alias(c) for c in same],
        F.count_if("_out").alias("outliers"),
    )
    return numbers.join(group_mode(base, keys, value), list(keys))


def box_stats(df: DataFrame, value: str, keys: Sequence[str], scale: int = 6) -> DataFrame:
    """Five numbers, whisker ends and number of outliers per group."""
    base = with_keys(df, keys).where(F.col(value).isNotNull())
    inner = F.when(~F.col("_out"), F.col(value))
    return _with_fences(base, value, keys).groupBy(*keys).agg(
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.min(inner).alias("whisker_low"),
        F.max(inner).alias("whisker_high"),
        F.count_if("_out").alias("outliers"),
        *[F.bround(F.max(c), scale).alias(c) for c in QUARTILES],
    )


def quantile_table(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), scale: int = 6) -> DataFrame:
    """One row per quantile."""
    q = quantiles(df, value, probs, keys, "_q")
    long = q.select(*keys, F.posexplode("_q").alias("_i", "_v"))
    names = F.array(*[F.lit(float(p)) for p in probs])
    return long.select(*keys, F.element_at(names, F.col("_i") + 1).alias("p"), F.bround("_v", scale).alias("value"))


def corr_matrix(df: DataFrame, columns: Sequence[str], scale: int = 6) -> DataFrame:
    """Pearson correlation of every pair of columns, long form, from one aggregate.

    Each pair uses the rows where both values are present.
    """
    pairs = list(combinations(columns, 2))
    one = df.agg(
        *[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs],
        *[F.when(F.var_pop(c) > 0, F.lit(1.0)).alias(f"{c}~{c}") for c in columns],
    )
    cells = [(a, b, f"{a}~{b}") for a, b in pairs] + [(b, a, f"{a}~{b}") for a, b in pairs] + [(c, c, f"{c}~{c}") for c in columns]
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.bround(F.col(f"`{n}`"), scale).alias("r")) for a, b, n in cells])
    return one.select(F.explode(rows).alias("c")).select("c.*")


def regression_pairs(df: DataFrame, columns: Sequence[str], scale: int = 6) -> DataFrame:
    """Least-squares line and correlation for every pair x before y, from one aggregate."""
    fits = []
    for x, y in combinations(columns, 2):
        u, v = F.col(x).cast("double"), F.col(y).cast("double")
        parts = {"slope": F.regr_slope(v, u), "intercept": F.regr_intercept(v, u), "r": F.corr(u, v)}
        fits.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), *[F.bround(c, scale).alias(n) for n, c in parts.items()]))
    return df.agg(F.array(*fits).alias("_f")).select(F.explode("_f").alias("f")).select("f.*")


def welch_t(df: DataFrame, target: Column, columns: Sequence[str], scale: int = 6, alpha: float = 0.05, p_values: bool = True) -> DataFrame:
    """Welch's t of each column between rows with and without the target, one pass."""

    def side(c: str, on: Column) -> list[Column]:
        v = F.when(on, F.col(c).cast("double"))
        return [F.count(v), F.avg(v), F.var_samp(v)]

    yes, no = F.coalesce(target, F.lit(False)), ~F.coalesce(target, F.lit(False))
    stats = []
    for c in columns:
        (n1, m1, v1), (n0, m0, v0) = side(c, yes), side(c, no)
        parts = zip(["n1", "m1", "v1", "n0", "m0", "v0"], [n1, m1, v1, n0, m0, v0])
        stats.append(F.struct(F.lit(c).alias("column"), *[x.alias(n) for n, x in parts]))
    rows = df.agg(F.array(*stats).alias("_s")).select(F.explode("_s").alias("s")).select("s.*")
    a, b = safe_ratio("v1", "n1"), safe_ratio("v0", "n0")
    dof = safe_ratio((a + b) * (a + b), safe_ratio(a * a, F.col("n1") - 1) + safe_ratio(b * b, F.col("n0") - 1))
    out = rows.withColumns({"mean_diff": F.col("m1") - F.col("m0"), "t": safe_ratio(F.col("m1") - F.col("m0"), F.sqrt(a + b)), "dof": dof})
    keep = ["column", "n1", "n0", *[F.bround(c, scale).alias(c) for c in ["mean_diff", "t", "dof"]]]
    if not p_values:
        return out.select(*keep)
    out = out.withColumn("_p", t_pvalue("t", "dof"))
    return out.select(*keep, F.bround("_p", 10).alias("p_value"), (F.col("_p") < alpha).alias("significant"))


def chi2(df: DataFrame, columns: Sequence[str], target: str, scale: int = 6, alpha: float = 0.05, p_values: bool = True) -> DataFrame:
    """Chi-square test of independence of each column from the target.

    With one degree of freedom Yates' correction is applied: each deviation
    shrinks by up to 0.5. Only cells that occur are counted and joined to their
    marginals; the counted cells are pinned, so the rows are read once. An empty cell adds its expected count, so all empty cells
    together add n less the expected counts of the others; in a 2 x 2 table all
    four deviations are equal and the sum of 1 / expected is
    n * sum(1 / row) * sum(1 / column). The full table is never built.
    """
    cols = [F.col(c).cast("string").alias(c) for c in columns]
    long = df.select(F.col(target).cast("string").alias("_t"), *cols).unpivot(["_t"], list(columns), "column", "level")
    cells = pinned(with_keys(long, ["_t", "level"]).groupBy("column", "level", "_t").agg(F.count(F.lit(1)).cast("double").alias("_o")))
    rows = cells.groupBy("column", "level").agg(F.sum("_o").alias("_r"))
    sides = cells.groupBy("column", "_t").agg(F.sum("_o").alias("_c"))
    whole = rows.groupBy("column").agg(F.sum("_r").alias("n"), F.count(F.lit(1)).alias("_nr"), F.sum(1 / F.col("_r")).alias("_ir"))
    whole = whole.join(sides.groupBy("column").agg(F.count(F.lit(1)).alias("_nc"), F.sum(1 / F.col("_c")).alias("_ic")), "column")
    full = cells.join(rows, ["column", "level"]).join(sides, ["column", "_t"]).join(whole, "column")
    e = F.col("_r") * F.col("_c") / F.col("n")
    gap = F.abs(F.col("_o") - e)
    sums = full.groupBy("column").agg(
        *[F.max(c).alias(c) for c in ["n", "_nr", "_nc", "_ir", "_ic"]],
        F.sum(gap * gap / e).alias("_seen"),
        F.sum(e).alias("_e"),
        F.max(gap).alias("_gap"),
    )
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    shrunk = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    yates = shrunk * shrunk * F.col("n") * F.col("_ir") * F.col("_ic")
    plain = F.col("_seen") + F.greatest(F.col("n") - F.col("_e"), F.lit(0.0))
    out = sums.select("column", F.col("n").cast("long").alias("n"), dof.alias("dof"), F.when(dof == 1, yates).otherwise(plain).alias("_x"))
    keep = ["column", "n", "dof", F.bround("_x", scale).alias("chi2")]
    if not p_values:
        return out.select(*keep)
    out = out.withColumn("_p", F.when(F.col("dof") > 0, chi2_pvalue("_x", F.col("dof").cast("double"))).otherwise(F.lit(1.0)))
    return out.select(*keep, F.bround("_p", 10).alias("p_value"), (F.col("_p") < alpha).alias("significant"))


def profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], scale: int = 6) -> DataFrame:
    """Every column's nulls, distinct values, top value, zeros and quartiles over all rows.

    One aggregate gives all that a single pass can count, one the values.
    """

    def one_pass(c: str) -> Column:
        v, is_number = F.col(c).cast("double") + 0.0 if c in numeric else F.lit(None).cast("double"), c in numeric
        numbers = {"mean": F.bround(F.avg(v), scale), "std": F.bround(F.stddev_samp(v), scale), "min": F.min(v), "max": F.max(v)}
        zeros = F.count_if(v == 0) if is_number else F.lit(None).cast("long")
        return F.struct(F.lit(c).alias("column"), F.lit("numeric" if is_number else "categorical").alias("kind"), F.count(F.lit(1)).alias("rows"),
                        F.count_if(F.col(c).isNull()).alias("nulls"), *[x.alias(n) for n, x in numbers.items()], zeros.alias("zeros"))

    columns = [*numeric, *categorical]
    base = df.agg(F.array(*[one_pass(c) for c in columns]).alias("_p")).select(F.explode("_p").alias("p")).select("p.*")
    top = describe_categorical(df, columns).select("column", "unique", "top", "freq")
    quart = quantile_columns(long_form(df, numeric), "value", QUARTILES, ["column"], scale)
    return base.join(top, "column", "left").join(quart, "column", "left")


def shape_label(skew: Column, kurtosis: Column, skew_limit: float = 1.0, kurtosis_limit: float = 3.0) -> tuple[Column, Column]:
    """Words for a skewness and an excess kurtosis; null without a number."""
    side = F.when(skew > skew_limit, "right-skewed").when(skew < -skew_limit, "left-skewed").when(skew.isNotNull(), "even")
    tail = F.when(kurtosis > kurtosis_limit, "peaked").when(kurtosis.isNotNull(), "gentle")
    return side, tail
