"""Contingency tables and pivots. Column values are given, so no extra job finds them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import ordinal, row_sum, safe_ratio
from millrace.operators.aggregates import with_keys


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence[str], margins: bool = False, total: str = "total") -> DataFrame:
    """Counts per row and column value, empty cells 0, with totals if asked.

    Totals count every row with both keys, also those of unlisted column values.
    """
    base = with_keys(df, [rows, cols])
    cells = [F.count_if(F.col(cols) == F.lit(v)).alias(str(v)) for v in values]
    if not margins:
        return base.groupBy(rows).agg(*cells)
    full = base.groupBy(rows).agg(*cells, F.count(F.lit(1)).alias(total))
    return with_total_row(full, rows, [*map(str, values), total], total)


def with_total_row(df: DataFrame, label_column: str, measures: Sequence[str], label: str = "total") -> DataFrame:
    """A grand-total row appended to a reduced table."""
    sums = df.agg(*[F.coalesce(F.sum(F.col(f"`{m}`")), F.lit(0)).alias(m) for m in measures])
    return df.unionByName(sums.withColumn(label_column, F.lit(label)))


def crosstab_pct(df: DataFrame, rows: str, cols: str, values: Sequence[str], scale: int = 6) -> DataFrame:
    """Percentage of each column value within a row; a value that never occurs is 0.

    The row total counts every value, listed or not.
    """
    base = with_keys(df, [rows, cols])
    cells = [F.count_if(F.col(cols) == F.lit(v)) for v in values]
    return base.groupBy(rows).agg(*[F.bround(c * 100.0 / F.count(F.lit(1)), scale).alias(str(v)) for c, v in zip(cells, values)])


def flag_crosstab(df: DataFrame, rows: str, flags: Mapping[str, Column], total: str = "total", missing: str | None = None) -> DataFrame:
    """Counts of non-exclusive flags per row value, with a total column and row.

    The total adds up the flags, so a row with two flags counts twice. Row
    values without any flag are left out, as in a table built flag by flag.
    """
    key = F.coalesce(F.col(rows), F.lit(missing)) if missing is not None else F.col(rows)
    counted = with_keys(df.withColumn(rows, key), [rows]).groupBy(rows).agg(
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()]
    )
    full = counted.withColumn(total, row_sum(list(flags))).where(F.col(total) > 0)
    return with_total_row(full, rows, [*flags, total], total)


def pivot_mean(
    df: DataFrame, rows: str, cols: str, value: str, values: Sequence, order: Sequence[str] | None = None, scale: int = 6
) -> DataFrame:
    """Mean per row and column value, rows in a custom order if given."""
    base = with_keys(df, [rows, cols])
    wide = base.groupBy(rows).pivot(cols, list(values)).agg(F.bround(F.avg(value), scale))
    return wide.orderBy(ordinal(rows, order), rows) if order else wide


def with_total_column(df: DataFrame, measures: Sequence[str], total: str = "total") -> DataFrame:
    return df.withColumn(total, row_sum(list(measures)))


def with_totals(df: DataFrame, label_column: str, measures: Sequence[str], total: str = "total") -> DataFrame:
    """A total column and a grand-total row."""
    return with_total_row(with_total_column(df, measures, total), label_column, [*measures, total], total)


def ratio_index(table: DataFrame, num: Sequence[str], den: str, out: str = "ratio_index", scale: int = 4) -> DataFrame:
    """(sum of the numerator columns) / denominator, null over 0."""
    top = reduce(lambda a, b: a + b, [F.col(c) for c in num])
    return table.withColumn(out, safe_ratio(top, den, scale))
