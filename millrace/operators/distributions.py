"""Histograms, bands and densities as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import factorial, pi, sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.columns import bucketize, col
from millrace.operators.joins import salted_join
from millrace.session import pinned


def histogram(
    df: DataFrame, value: Column | str, bins: int, by: str | None = None, norm: str = "count", scale: int = 6
) -> DataFrame:
    """Equal-width bins over the range of the whole column, the last bin closed.

    ``norm='probability'`` divides by the rows of the class (or of the table).
    Bins without rows are not listed.
    """
    keys = [by] if by else []
    v = df.select(*keys, col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    v = v.na.drop(subset=keys) if keys else v
    # one scan finds the range; it enters the plan as constants
    span = v.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).select(F.struct("lo", "hi")).scalar()
    v = v.withColumn("_s", span)
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    width = (hi - lo) / F.lit(bins)
    index = F.when(width > 0, F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = v.groupBy(*keys, index.cast("int").alias("bin"), lo.alias("_lo"), width.alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    out = counts.select(
        *keys, "bin", "n", F.bround(F.col("_lo") + F.col("_w") * F.col("bin"), scale).alias("bin_start"),
        F.bround(F.col("_lo") + F.col("_w") * (F.col("bin") + 1), scale).alias("bin_end"),
    )
    if norm == "probability":
        # at most ``bins`` rows per class
        w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        out = out.withColumn("probability", F.bround(F.col("n") / F.sum("n").over(w), scale))
    return out


def log_histogram(df: DataFrame, value: str, bins: int, **kw) -> DataFrame:
    return histogram(df, F.log1p(F.col(value)), bins, **kw)


def band_table(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str], metric: str, scale: int = 6) -> DataFrame:
    """Count, share, cumulative share and mean of another column per fixed band."""
    place = bucketize(value, edges, [str(i) for i in range(len(labels))]).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(place.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.avg(metric).alias("_m"))
    # one row per band from here on
    upto = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        "band",
        F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("band") + 1).alias("label"),
        "n",
        F.bround(F.col("n") * 100.0 / total, scale).alias("pct"),
        F.bround(F.sum("n").over(upto) * 100.0 / total, scale).alias("cum_pct"),
        F.bround("_m", scale).alias("avg_metric"),
    )


# Values meet the grid by cells of this share of a bandwidth, with this many powers of their place in it.
_CELL, _POWERS = 0.125, 8


def _in_cell() -> list[Column]:
    """The cell's kernels as a polynomial in the distance from its centre, lowest power first.

    exp(-(z - t)**2 / 2) is exp(-z * z / 2) times the sum of He_k(z) t**k / k!, He_k
    being the Hermite polynomials, so the sums of t**k stand for all values of a cell.
    """
    hermite = [[1], [0, 1]]
    for k in range(1, _POWERS):
        up, down = [0, *hermite[k]], [*hermite[k - 1], 0, 0]
        hermite.append([a - k * b for a, b in zip(up, down)])
    return [
        reduce(Column.__add__, [F.col(f"_t{k}") * (h[j] / factorial(k)) for k, h in enumerate(hermite) if j < len(h) and h[j]])
        for j in range(_POWERS + 1)
    ]


def kde(df: DataFrame, value: str, points: int = 50, by: str | None = None, scale: int = 8) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid over the column's range.

    Values are summed up per cell of an eighth of a bandwidth, as powers of their
    distance from its centre, and only cells meet grid points: the work per row
    does not depend on ``points``. What the powers left out would add is less than
    3e-14 of a kernel's height for each value. The bandwidths are one row per group;
    groups with infinite values have none.
    """
    keys = [by] if by else []
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    v = v.na.drop(subset=keys) if keys else v
    sizes = v.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_n"), F.stddev_samp("_v").alias("_sd"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    sizes = pinned(sizes.withColumn("_h", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))))
    lo, hi = sizes.agg(F.min("_lo"), F.max("_hi")).first()
    sizes = sizes.where((F.col("_h") > 0) & (F.col("_h") < float("inf"))).select(*keys, "_n", "_h", "_lo")
    if lo is None:
        xs = [0.0] * points
    else:
        xs = [lo + k * (hi - lo) / max(points - 1, 1) for k in range(points)]
    if keys:
        rows = salted_join(v, sizes, keys, "_v")
    else:
        rows = v.withColumn("_one", sizes.select(F.struct("_n", "_h", "_lo")).scalar()).select("_v", "_one.*").where(F.col("_h").isNotNull())
    group = [*keys, "_n", "_h", "_lo"]
    place = (F.col("_v") - F.col("_lo")) / F.col("_h")
    rows = rows.withColumn("_cell", F.floor(place / _CELL)).withColumn("_t", place - (F.col("_cell") + 0.5) * _CELL)
    powers = [F.lit(1.0)]
    for _ in range(_POWERS):
        powers.append(powers[-1] * F.col("_t"))
    cells = rows.groupBy(*group, "_cell").agg(*[F.sum(t).alias(f"_t{k}") for k, t in enumerate(powers)])
    centre = F.col("_lo") + (F.col("_cell") + 0.5) * _CELL * F.col("_h")
    cells = cells.select(*keys, "_n", "_h", centre.alias("_c"), F.array(*_in_cell()).alias("_b"))
    grid = cells.select("*", F.posexplode(F.array(*map(F.lit, xs))).alias("point", "_x")).withColumn("_z", (F.col("_x") - F.col("_c")) / F.col("_h"))
    series = F.get("_b", F.lit(_POWERS))
    for j in reversed(range(_POWERS)):
        series = series * F.col("_z") + F.get("_b", F.lit(j))
    # beyond 40 bandwidths a kernel is zero in double precision, and its powers may not fit
    height = F.when(F.abs("_z") < 40, series * F.exp(-0.5 * F.col("_z") * F.col("_z"))).otherwise(0.0)
    out = grid.groupBy(*keys, "point", "_x").agg(F.bround(F.sum(height / (F.col("_n") * F.col("_h") * F.lit(sqrt(2 * pi)))), scale).alias("density"))
    return out.select(*keys, "point", F.bround("_x", 6).alias("x"), "density")
