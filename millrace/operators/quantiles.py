"""Exact quantiles without gathering a group in one task, reading the rows twice.

A quantile lies between two values of known rank, and those are found by
selection.

1. Rows are counted per bin of a monotone scale of relative width 1/64, with bins
   of their own for zero and the infinities. A rank that is the first or the last
   of its bin is its least or greatest value, which the bins hold.
2. For the other ranks, the values in their bins are counted and written once.
   The rows are not read again.
3. Bins of more than ``_LAST`` values are split into 4096 equal parts, again and
   again; in what is left the values are ordered and their counts summed up.

Every pass is a grouped count with map-side combining. Rows meet the few wanted
bins on a salted key, so a group that holds a third of the rows is spread over
all tasks, and what a window orders is bounded. The bins depend on nothing but the
values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import pinned, salts

_COARSE_PER_E = 64
# Above the logarithm of 1 / (smallest double), so every logarithm becomes positive.
_LOG_FLOOR = 746.0
_INFINITE = 1 << 20
_PARTS = 4096
# distinct values that one task puts in order
_LAST = 65_536


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str], within: Column | None = None) -> DataFrame:
    """Inner join on keys that may be null; the right side's copies are dropped."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, cond if within is None else cond & within).drop(*[f"_r_{k}" for k in keys])


def _narrow(counts: DataFrame, within: Sequence[str], at: str) -> DataFrame:
    """Keep the ordered cells that hold a wanted rank.

    ``counts`` has ``_n`` rows per cell, ``_skip`` rows before the first cell
    and the ``_want`` ranks; the result carries both on for the cell itself.
    """
    w = Window.partitionBy(*within).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = counts.withColumn("_end", F.col("_skip") + F.sum("_n").over(w)).withColumn("_skip", F.col("_end") - F.col("_n"))
    return run.withColumn("_want", F.expr("filter(_want, r -> r >= _skip and r < _end)")).where(F.size("_want") > 0).drop("_end")


def _at_ends(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, rank, value) of the ranks that are the first or last of their cell."""
    known = F.expr("transform(_want, r -> struct(r as _r, case when r = _skip or _lo = _hi then _lo when r = _skip + _n - 1 then _hi end as _v))")
    return cells.select(*by, "_total", F.explode(known).alias("_k")).select(*by, "_total", "_k._r", "_k._v").where("_v is not null")


def _inside(cells: DataFrame) -> DataFrame:
    """Cells with ranks that are neither first nor last."""
    return cells.withColumn("_want", F.expr("filter(_want, r -> r > _skip and r < _skip + _n - 1)")).where("_lo < _hi and size(_want) > 0")


def quantiles(df: DataFrame, value: Column | str, probs: Sequence[float], by: Sequence[str] = (), out: str = "q") -> DataFrame:
    """Exact linear-interpolated quantiles per group, as an array in ``probs`` order.

    Nulls and NaN are left out; infinities count as the values they are. The rows
    of ``df`` are read once when this is called, and once more unless the bins
    hold all values wanted; what comes of them is pinned.
    """
    by = list(by)
    c = F.col(value) if isinstance(value, str) else value
    v = df.select(*by, c.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # log is semi-monotonic by the Java specification, so the scale keeps the order
    size = F.when(F.abs("_v") == float("inf"), F.lit(float(_INFINITE))).otherwise((F.log(F.abs(F.col("_v"))) + _LOG_FLOOR) * _COARSE_PER_E)
    v = v.withColumn("_bin", F.when(F.col("_v") == 0, F.lit(0)).otherwise(F.floor(F.signum("_v") * size)).cast("int"))

    bins = v.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    places = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(p) for p in places for f in (F.floor, F.ceil)]))
    bins = bins.withColumn("_total", F.sum("_n").over(Window.partitionBy(*by))).withColumns({"_want": ranks, "_skip": F.lit(0).cast("long")})
    cells = pinned(_narrow(bins, by, "_bin"))
    pairs = _at_ends(cells, by)

    cell = [*by, "_bin", "_cell"]
    if not (open_ := _inside(cells)).isEmpty():
        n = salts(df.sparkSession)
        salted = v.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int"))
        dealt = open_.select(*by, "_bin", F.col("_lo").alias("_cell"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_salt"))
        values = pinned(_meet(salted, dealt, [*by, "_bin", "_salt"]).groupBy(*cell, "_v").agg(F.count(F.lit(1)).alias("_c")))
        open_ = open_.withColumn("_cell", F.col("_lo"))
        while values.groupBy(*cell).count().where(F.col("count") > _LAST).limit(1).count():
            inside = _meet(values, open_.select(*cell, "_lo", "_hi"), cell)
            part = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * _PARTS), F.lit(_PARTS - 1)).cast("int")
            parts = inside.groupBy(*cell, part.alias("_part")).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
            parts = _meet(parts, open_.select(*cell, "_total", "_want", "_skip"), cell)
            cells = pinned(_narrow(parts, cell, "_part").select(*cell, "_total", "_want", "_skip", "_n", F.col("_min").alias("_lo"), F.col("_max").alias("_hi")))
            pairs = pairs.unionByName(_at_ends(cells, by))
            open_ = _inside(cells)
            kept = _meet(values, open_.select(*cell, "_lo", "_hi"), cell, F.expr("_v >= _lo and _v <= _hi"))
            values = pinned(kept.select(*by, "_bin", F.col("_lo").alias("_cell"), "_v", "_c"))
            open_ = open_.withColumn("_cell", F.col("_lo"))
        wanted = _meet(values.withColumnRenamed("_c", "_n"), open_.select(*cell, "_total", "_want", "_skip"), cell)
        found = _narrow(wanted, cell, "_v")
        pairs = pairs.unionByName(found.select(*by, "_total", F.explode("_want").alias("_r"), "_v"))

    at = pairs.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        F.map_from_entries(F.collect_set(F.struct("_r", "_v"))).alias("_at"),
    ).where(F.col("_total").isNotNull())
    q = []
    for place in places:
        low, high = F.element_at("_at", F.floor(place)), F.element_at("_at", F.ceil(place))
        q.append(F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))))
    return at.select(*by, F.array(*q).alias(out))


def quantile_columns(df: DataFrame, value, probs: dict[str, float], by: Sequence[str] = (), scale: int | None = 6) -> DataFrame:
    """:func:`quantiles` with one named column per quantile."""
    q = quantiles(df, value, list(probs.values()), by, "_q")
    cols = [F.element_at("_q", i + 1) for i in range(len(probs))]
    if scale is not None:
        cols = [F.bround(c, scale) for c in cols]
    return q.select(*by, *[c.alias(n) for c, n in zip(cols, probs)])
