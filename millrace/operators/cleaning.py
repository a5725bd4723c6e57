"""Table-level projections and filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import in_values, not_in_values
from millrace.functions.text import search_hit


def standardize(df: DataFrame, mapping: Mapping[str, Column | str], source: str | None = None, label: str = "source") -> DataFrame:
    """Columns of a standard schema, plus a constant source column."""
    cols = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()]
    return df.select(*([F.lit(source).alias(label)] if source is not None else []), *cols)


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Null replaced per column."""
    return df.na.fill(dict(values))


def filter_in(df: DataFrame, keep: Mapping[str, Sequence] | None = None, drop: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Rows whose columns are among the kept values and not among the dropped ones."""
    tests = [in_values(c, v) for c, v in (keep or {}).items()] + [not_in_values(c, v) for c, v in (drop or {}).items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def slice_by(df: DataFrame, **values) -> DataFrame:
    """Rows equal to every given value; pushed down to the scan."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()], F.lit(True)))


def drop_missing(df: DataFrame, cols: Sequence[str], total_column: str | None = None, total_label: str | None = None) -> DataFrame:
    """Rows without nulls in ``cols``, and without the total row."""
    kept = df.na.drop(subset=list(cols))
    return kept if total_column is None else kept.where(~F.col(total_column).eqNullSafe(F.lit(total_label)))


def search(df: DataFrame, cols: Sequence[str], query: str) -> DataFrame:
    """Rows whose joined columns hold every word of the query, ignoring case."""
    return df.where(search_hit(cols, query))


def melt_split(df: DataFrame, ids: Sequence[str], columns: Sequence[str], pattern: str, parts: Sequence[str], value: str = "value") -> DataFrame:
    """Wide to long, the column name split into dimensions by the pattern's groups.

    Names are split once, here, and enter the plan as constants.
    """
    cells = []
    for c in columns:
        found = re.search(pattern, c)
        if not found:
            raise ValueError(f"{c} does not fit {pattern}")
        names = [F.lit(found.group(i + 1)).alias(p) for i, p in enumerate(parts)]
        cells.append(F.struct(*names, F.col(c).alias(value)))
    return df.select(*ids, F.explode(F.array(*cells)).alias("_cell")).select(*ids, "_cell.*")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Tables stacked by column name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
