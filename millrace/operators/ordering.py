"""Ranking, top-k, samples and deduplication with explicit tie-breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.columns import ordinal, safe_ratio
from millrace.operators.running import running_total
from millrace.sources.writers import one_per_key


def flag_top(df: DataFrame, group: str, value: str, tie: str, out: str = "is_top") -> DataFrame:
    """Mark the row with the largest value of each group, the smallest ``tie`` on ties.

    The winners are found with one row per group and task, then met on
    (group, tie), which spreads a hot group over all tasks.
    """
    ranked = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(group, tie, value)
    winners = one_per_key(ranked, [group], [F.desc(value), F.asc(tie)]).select(group, tie, F.lit(True).alias(out))
    return df.join(winners, [group, tie], "left").withColumn(out, F.coalesce(out, F.lit(False)))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group; cut to ``n`` per task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def pareto(df: DataFrame, key: str, threshold: float | None = None, scale: int = 6) -> DataFrame:
    """Rows per key by falling count with the cumulative percentage, up to a threshold."""
    base = df.where(F.col(key).isNotNull())
    counts = base.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = base.agg(F.count(F.lit(1))).scalar()
    run = running_total(counts, [F.desc("n"), F.asc(key)], "n", "_run")
    out = run.select(key, "n", F.bround(F.col("_run") * 100.0 / total, scale).alias("cum_pct"))
    return out if threshold is None else out.where(F.col("cum_pct") <= threshold)


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key set in order; null keys count as equal."""
    return one_per_key(df, keys, order)


def extremes(df: DataFrame, value: str, tie: str) -> DataFrame:
    """The row with the largest and the row with the smallest value."""
    known = df.where(F.col(value).isNotNull())
    top = known.orderBy(F.desc(value), F.asc(tie)).limit(1).withColumn("extreme", F.lit("max"))
    low = known.orderBy(F.asc(value), F.asc(tie)).limit(1).withColumn("extreme", F.lit("min"))
    return top.unionByName(low)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows; each task keeps ``k`` and the heaps are merged."""
    return df.orderBy(*order).limit(k)


def with_order(df: DataFrame, column: str, order: Sequence[str], out: str = "ord") -> DataFrame:
    return df.withColumn(out, ordinal(column, order))


def _digest(keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def sample_frac(df: DataFrame, keys: Sequence[str], permille: int) -> DataFrame:
    """About ``permille`` / 1000 of the rows, chosen by a hash of the key, so always the same ones."""
    bucket = F.conv(F.substring(_digest(keys), 1, 8), 16, 10).cast("long") % 1000
    return df.where(bucket < permille)


def _cut(cells: DataFrame, before: Column, n: int) -> tuple[Column, Column]:
    """The cell in which the ``n``-th row lies, and the rows before it, as scalar subqueries."""
    w = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = cells.withColumn("_b", F.sum("_n").over(w) - F.col("_n") + before).where(F.col("_b") < n)
    last = run.agg(F.max(F.struct("_c", "_b")).alias("_x")).select("_x.*")
    return last.select("_c").scalar(), last.select("_b").scalar()


def sample_n(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Exactly ``n`` rows (or all), those with the smallest key digests; keys are unique.

    Counts per four-digit digest prefix (65,536 cells) find the cell that holds
    the last row, and counts of the next four digits narrow it down. Cells before
    it are kept whole, so only the rows of one cell in 2^32 are ranked.
    """
    marked = df.withColumn("_md5", _digest(keys))
    first, second = F.substring("_md5", 1, 4), F.substring("_md5", 5, 4)
    count = F.count(F.lit(1)).alias("_n")
    cut, skip = _cut(marked.groupBy(first.alias("_c")).agg(count), F.lit(0), n)
    inner = marked.where(first == cut)
    cut2, skip2 = _cut(inner.groupBy(second.alias("_c")).agg(count), skip, n)
    whole = marked.where((first < cut) | ((first == cut) & (second < cut2)))
    rank = F.row_number().over(Window.orderBy("_md5", *keys))
    edge = inner.where(second == cut2).withColumn("_rank", rank).where(F.col("_rank") <= n - skip2).drop("_rank")
    return whole.unionByName(edge).drop("_md5")


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` smallest distinct keys as a work list."""
    return df.select(key).distinct().orderBy(key).limit(n)


def distinct_ordered(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with the place they were first seen at, in that order."""
    return df.groupBy(value).agg(F.min(order).alias("first_seen")).orderBy("first_seen", value)


def step_change(df: DataFrame, keys: Sequence[str], order: str, value: str, scale: int = 6) -> DataFrame:
    """Previous and first value along an order with the change and its percentage.

    Meant for reduced tables such as one row per day and key.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumns({"previous": F.lag(value).over(w), "first": F.first(value).over(w)})
    change = F.col(value) - F.col("previous")
    return out.withColumns({"change": change, "change_pct": safe_ratio(change * 100.0, "previous", scale)})
