"""Joins. Which side is broadcast is left to Catalyst, which checks sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.lookup import Names, first_occurring
from millrace.session import salts
from millrace.sources.writers import one_per_key


def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join to a dimension with unique keys; unmatched rows get the defaults."""
    joined = fact.join(dim, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def lookup(df: DataFrame, key: str, table: DataFrame, value: str, order: Sequence[Column], keep: str = "last", out: str | None = None) -> DataFrame:
    """Value of a key-value table attached by key; of duplicate keys the first or last in order wins.

    ``table`` holds the key under the same name as ``df``. With ``keep='first'``
    null values are passed over.
    """
    if keep == "first":
        table = table.where(F.col(value).isNotNull())
        pick = list(order)
    else:
        pick = [c.desc() for c in order]
    unique = one_per_key(table, [key], pick).select(key, F.col(value).alias(out or value))
    return df.join(unique, [key], "left")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], salt_by: str) -> DataFrame:
    """Inner join of many rows with a table of one row per key, hot keys split.

    The left rows of a key are dealt to as many tasks as a shuffle has, by the
    hash of a column that varies within the key; the right row is copied to each
    of them. Unlike the adaptive skew split, this also works when the result is
    grouped by the same key straight after.
    """
    n = salts(left.sparkSession)
    a = left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(n)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return a.join(b, [*on, "_salt"]).drop("_salt")


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``; copies of a key are removed before the shuffle."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def tiered_join(
    left: DataFrame,
    right: DataFrame,
    region_left: str,
    name_left: str,
    region_right: str,
    name_right: str,
    measures: Sequence[str],
    special: Column | None = None,
    prefix: int = 2,
) -> DataFrame:
    """Sum the right rows that match a left row by the first tier that hits.

    Within the same region prefix: 1 the names are equal, 2 the right name
    contains the left one, 3 (``special`` left rows only) the whole region.
    ``tier`` is null and the sums are 0 when nothing matches.

    The right side is summed per prefix and name, and per prefix, before it meets
    the left side. The second tier meets on anchors: a left name is known by its
    first 1, 2, 4, 8 or 16 characters, whichever is the most it has, and right
    names emit their distinct runs of those lengths.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    r = right.select(F.substring(region_right, 1, prefix).alias("_p"), F.coalesce(F.col(name_right), F.lit("")).alias("_s"), *measures)
    exact = r.groupBy("_p", "_s").agg(*sums)
    region = exact.groupBy("_p").agg(*sums)
    names = left.select(F.substring(region_left, 1, prefix).alias("_p"), F.col(name_left).alias("_name")).where("_name <> ''").distinct()
    met = names.withColumn("_anchor", anchor("_name")).join(exact.withColumn("_anchor", F.explode(anchors("_s"))), ["_p", "_anchor"])
    contains = met.where(F.contains("_s", "_name")).groupBy("_p", F.col("_name").alias("_s")).agg(*sums)
    contains = contains.unionByName(region.withColumn("_s", F.lit("")))  # every name contains the empty one

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in measures], F.struct(*measures).alias(name))

    out = left.withColumns({"_p": F.substring(region_left, 1, prefix), "_s": F.col(name_left)})
    out = out.join(packed(exact, "_t1"), ["_p", "_s"], "left").join(packed(contains, "_t2"), ["_p", "_s"], "left")
    out = out.join(packed(region, "_t3"), ["_p"], "left")
    t3 = F.when(special if special is not None else F.lit(False), F.col("_t3"))
    best = F.coalesce("_t1", "_t2", t3)
    tier = F.when(F.col("_t1").isNotNull(), 1).when(F.col("_t2").isNotNull(), 2).when(t3.isNotNull(), 3)
    picked = out.withColumn("_best", best)
    return picked.select(
        *left.columns, tier.alias("tier"), *[F.coalesce(F.col(f"_best.{m}"), F.lit(0)).alias(m) for m in measures]
    )


ANCHORS = (1, 2, 4, 8, 16)


def anchor(name: Column | str) -> Column:
    """The start of a name by which it is looked up: the longest of the anchor lengths it has."""
    c = F.col(name) if isinstance(name, str) else name
    size = F.length(c)
    return F.substring(c, F.lit(1), reduce(lambda a, n: F.when(size >= n, n).otherwise(a), ANCHORS[1:], F.lit(ANCHORS[0])))


def anchors(text: Column | str) -> Column:
    """All distinct runs of the anchor lengths in a text, cut in one pass for each length."""
    c = F.col(text) if isinstance(text, str) else text
    runs = [F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))) for n in ANCHORS]
    return F.concat(*runs)


def contains_join(
    df: DataFrame, key: str, text: str, catalogue: DataFrame, name: str, order: str, payload: Sequence[str], min_length: int = 2
) -> DataFrame:
    """Attach the first catalogue row whose name occurs in the text, ignoring case.

    ``key`` identifies a row of ``df``. Each text is read once for each block of
    names, of which there is one up to some hundred thousand names; only hits are
    shuffled. Names of equal order come by name; of equal names the first counts.
    """
    names = catalogue.select(F.lower(name).alias("_what"), F.col(order).alias("_ord"), *payload).where(F.length("_what") >= min_length)
    names = one_per_key(names, ["_what"], [F.col("_ord").asc()])
    return first_occurring(df, key, F.lower(text), names, payload, Names)


def attach_metric(features: DataFrame, metric: DataFrame, key: str, value: str, mode: str = "null") -> DataFrame:
    """Metric attached by key; missing becomes null, 0, or the mean of the metric."""
    out = features.join(metric.select(key, value), [key], "left")
    if mode == "zero":
        return out.withColumn(value, F.coalesce(F.col(value), F.lit(0)))
    if mode == "mean":
        return out.withColumn(value, F.coalesce(F.col(value), metric.agg(F.avg(value)).scalar()))
    return out


def densify(df: DataFrame, keys: Sequence[str], fills: Mapping[str, object], domains: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One row for every combination of the keys' categories; new rows take ``fills``, else null.

    Categories are given, or are those that occur. Those of a further key are
    dealt to as many lists as a shuffle has tasks; the rows so far meet every
    list by its number, so no task needs all categories at once.
    """
    domains, spark = dict(domains or {}), df.sparkSession
    n = salts(spark)

    def categories(k: str) -> DataFrame:
        if k in domains:
            return spark.createDataFrame([(x,) for x in domains[k]], f"`{k}` {df.schema[k].dataType.simpleString()}").distinct()
        return df.select(k).where(F.col(k).isNotNull()).distinct()

    spine = categories(keys[0])
    for k in keys[1:]:
        lists = categories(k).groupBy(F.pmod(F.xxhash64(k), F.lit(n)).alias("_list")).agg(F.collect_list(k).alias("_values"))
        spine = spine.withColumn("_list", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(lists, "_list")
        spine = spine.withColumn(k, F.explode("_values")).drop("_list", "_values")
    out = spine.join(df, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})
