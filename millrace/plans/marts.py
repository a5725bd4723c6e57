"""Multi-step jobs built from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import safe_ratio
from millrace.functions.dates import is_weekend
from millrace.operators.aggregates import group_median, with_keys
from millrace.operators.crosstabs import ratio_index
from millrace.operators.joins import densify, enrich, tiered_join
from millrace.operators.ordering import sample_frac
from millrace.session import pinned
from millrace.sources.writers import publish


def hourly_fact(events: DataFrame, ts: str) -> DataFrame:
    """Hour of the day and weekday / weekend added to an event table."""
    day_type = F.when(is_weekend(ts), F.lit("weekend")).otherwise(F.lit("weekday"))
    return events.withColumns({"hour": F.hour(ts), "day_type": day_type})


def level_means(fine: DataFrame, keys: Sequence[str], split: str, label: str, scale: int = 8) -> DataFrame:
    """Mean per keys and per value of ``split``, and over all of them under ``label``.

    ``fine`` carries ``_n`` and ``_s`` at a finer level, so no fact row is read again.
    """
    split_rows = fine.groupBy(*keys, split).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    both = split_rows.groupingSets([[F.col(k) for k in [*keys, split]], [F.col(k) for k in keys]], *keys, split).agg(
        F.sum("_n").alias("n"), F.sum("_s").alias("_s"), F.grouping(split).alias("_g")
    )
    shown = F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(split)).alias(split)
    return both.select(*keys, shown, "n", F.bround(safe_ratio("_s", "n"), scale).alias("mean"))


def fine_mart(fact: DataFrame, dim: DataFrame, on: str, area: str, place: str, category: str, value: str, missing: str = "unassigned", by: Sequence[str] = ()) -> DataFrame:
    """The fact joined and reduced once to (by, area, place, category, hour, day type).

    Counts and sums are kept, so such tables of different days add up.
    """
    rows = enrich(fact, dim, [on], {area: missing, place: missing})
    return rows.groupBy(*by, area, place, category, "hour", "day_type").agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))


def marts_of(fine: DataFrame, area: str, place: str, category: str, label: str = "all") -> dict[str, DataFrame]:
    """The marts by hour, by place and by category, read off a reduced fact of one or many days."""
    by_hour = fine.groupBy(area, place, "hour").agg(F.sum("_n").alias("n"), F.sum("_s").alias("_s"))
    return {
        "area_hours": level_means(fine, [area, "hour"], "day_type", label),
        "place_hours": level_means(fine, [area, place, "hour"], "day_type", label),
        "categories": fine.groupBy(area, place, category).agg(F.bround(F.sum("_s"), 2).alias("total")),
        "time_pattern": by_hour.select(area, place, "hour", "n", F.bround(safe_ratio("_s", "n"), 8).alias("mean")),
    }


def build_marts(
    fact: DataFrame, dim: DataFrame, on: str, area: str, place: str, category: str, value: str, sample_keys: Sequence[str], label: str = "all", missing: str = "unassigned", pin: bool = False
) -> dict[str, DataFrame]:
    """The pre-aggregates of an hourly fact by area and place.

    The fact is joined and reduced once to (area, place, category, hour, day
    type); the marts by hour, by place and by category are all read off that
    table, which ``pin`` writes once for all of them. Only the row sample goes
    back to the fact.
    """
    fine = fine_mart(fact, dim, on, area, place, category, value, missing)
    fine = pinned(fine) if pin else fine
    rows = enrich(fact, dim, [on], {area: missing, place: missing})
    return {**marts_of(fine, area, place, category, label), "sample": sample_frac(rows, sample_keys, 10), "dimension": dim}


def refresh_days(fact: DataFrame, dim: DataFrame, on: str, area: str, place: str, category: str, value: str, ts: str, path: str, days: Sequence[date], missing: str = "unassigned") -> None:
    """Bring the given days of a table of reduced days up to date; other days are not touched.

    Only rows of those days are read from the fact, their time bounds reaching
    the scan. A day's old rows give way when all new ones are written, so a
    failure changes nothing and a repeated call gives the same table. A day that
    has lost all its rows goes. The marts are ``marts_of`` the table at ``path``.
    """
    spark = fact.sparkSession
    if not days:
        return
    kind = fact.schema[ts].dataType
    within = [(F.col(ts) >= F.lit(d).cast(kind)) & (F.col(ts) < F.lit(d + timedelta(days=1)).cast(kind)) for d in sorted(set(days))]
    rows = fact.where(reduce(Column.__or__, within)).withColumn("day", F.to_date(ts))
    fine = pinned(fine_mart(rows, dim, on, area, place, category, value, missing, ["day"]))
    fine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    left = {r.day for r in fine.select("day").distinct().collect()}  # as many as days were given
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for d in set(days) - left:
        folder = hadoop(f"{path}/day={d}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def dense_categories(categories: DataFrame, area: str, place: str, category: str) -> DataFrame:
    """Totals for every combination of area, place and category, 0 where none occurred."""
    return densify(categories, [area, place, category], {"total": 0.0})


def publish_marts(marts: dict[str, DataFrame], folder: str) -> None:
    for name, df in marts.items():
        publish(df, f"{folder}/{name}")


def city_index(stores: DataFrame, city: str, flags: dict[str, Column], num: Sequence[str], den: str, coords: Sequence[str]) -> DataFrame:
    """Counts per flag, ratio index and median coordinates per city."""
    base = with_keys(stores, [city])
    counts = base.groupBy(city).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()], F.count(F.lit(1)).alias("total"))
    return ratio_index(counts, num, den).join(group_median(base, [city], coords), [city], "left")


def cartogram(grid: DataFrame, table: DataFrame, names: dict[str, str], num: Sequence[str], den: str, special: Column | None = None) -> DataFrame:
    """Measures of the matching table rows per grid cell and their ratio of sums."""
    out = tiered_join(grid, table, names["region_left"], names["name_left"], names["region_right"], names["name_right"], [*num, den], special)
    return ratio_index(out, num, den, "ratio", 6)
