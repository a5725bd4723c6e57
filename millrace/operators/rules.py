"""Rules, tags, scores and recommendations. Rules are data the caller passes in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import labels_or_default
from millrace.functions.text import any_of, num_unit, rx_contains
from millrace.operators.joins import contains_join
from millrace.operators.lookup import Patterns, first_occurring
from millrace.operators.ordering import top_n_per_group
from millrace.sources.writers import one_per_key


@dataclass(frozen=True)
class Rule:
    """A label given to texts that hold any of the words or match the pattern."""

    label: str
    words: tuple[str, ...] = ()
    pattern: str | None = None

    def test(self, text: Column) -> Column:
        """Condition on a lower-cased text."""
        tests = ([any_of(text, [w.lower() for w in self.words])] if self.words else []) + (
            [rx_contains(text, self.pattern)] if self.pattern else []
        )
        return reduce(lambda a, b: a | b, tests, F.lit(False))


def rule_text(columns: Sequence[str]) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def first_label(text: Column, rules: Sequence[Rule]) -> Column:
    """Label of the first rule that fits, else null."""
    return F.coalesce(*[F.when(r.test(text), F.lit(r.label)) for r in rules])


def classify(df: DataFrame, columns: Sequence[str], rules: Sequence[Rule], default: str, out: str = "label") -> DataFrame:
    """First-match label over the joined columns."""
    return df.withColumn(out, F.coalesce(first_label(rule_text(columns), rules), F.lit(default)))


def classify_by_table(df: DataFrame, key: str, text: str, rules: DataFrame, default: str, out: str = "label") -> DataFrame:
    """First-match label from a rule table ``(ord, word, label)`` of any size."""
    hit = contains_join(df, key, text, rules, "word", "ord", ["label"], min_length=1)
    return hit.withColumnRenamed("label", out).withColumn(out, F.coalesce(out, F.lit(default)))


def classify_by_patterns(df: DataFrame, key: str, text: str, rules: DataFrame, default: str, out: str = "label") -> DataFrame:
    """First-match label from a rule table ``(ord, label, pattern)`` of any size, ignoring case.

    Patterns are those of Python's ``re``. A pattern runs only on texts that hold a
    literal all its matches hold; patterns without one run on every text. Of equal
    patterns the first counts.
    """
    table = one_per_key(rules.select(F.col("pattern").alias("_what"), F.col("ord").alias("_ord"), F.col("label").alias(out)), ["_what"], [F.col("_ord").asc()])
    return first_occurring(df, key, F.col(f"`{text}`"), table, [out], Patterns).withColumn(out, F.coalesce(out, F.lit(default)))


def tag(df: DataFrame, columns: Sequence[str], rules: Sequence[Rule], default: str, out: str = "tags") -> DataFrame:
    """All labels that fit, in rule order, or the default."""
    text = rule_text(columns)
    return df.withColumn(out, labels_or_default(F.array(*[F.when(r.test(text), F.lit(r.label)) for r in rules]), default))


def tag_summary(tagged: DataFrame, tags: str, key: str, means: Sequence[str], scale: int = 6) -> DataFrame:
    """Rows and means per label; a row counts under each of its labels."""
    long = tagged.select(key, *means, F.explode(tags).alias("label"))
    return long.groupBy("label").agg(F.count(key).alias("n"), *[F.bround(F.avg(m), scale).alias(f"avg_{m}") for m in means])


def bridge(
    products: DataFrame,
    key: str,
    text: str,
    rules: Sequence[Rule],
    catalogue: DataFrame,
    name: str,
    order: str,
    note: str,
    defaults: tuple[str, str],
    notes: Mapping[str, str],
    safety: Sequence[Rule],
    safe: str = "None",
) -> DataFrame:
    """Ingredient, its note and a safety tag per product.

    The ingredient comes from the rules, else from the first catalogue name
    found in the text, else the default. Only products no rule fits are looked
    up in the catalogue.
    """
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    base = products.withColumns({"_rule": first_label(lower, rules), "_open": F.when(first_label(lower, rules).isNull(), F.col(text))})
    named = contains_join(base, key, "_open", catalogue.withColumn("_name", F.col(name)), name, order, ["_name", note])
    rule_note = F.try_element_at(F.create_map(*[F.lit(x) for kv in notes.items() for x in kv]), F.col("_rule"))
    return named.select(
        *products.columns,
        F.coalesce("_rule", "_name", F.lit(defaults[0])).alias("ingredient"),
        F.coalesce(rule_note, F.when(F.col("_rule").isNull(), F.col(note)), F.lit(defaults[1])).alias("function"),
        F.coalesce(first_label(lower, safety), F.lit(safe)).alias("safety"),
    )


def apply_exclusions(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows no rule excludes, and the rows each rule removed, in rule order.

    The number of the first failing rule is found once per row; the audit counts
    it and the kept rows are those without one.
    """
    place = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(i)) for i, (_, c) in enumerate(rules)])
    marked = df.withColumn("_fail", place)
    kept = marked.where(F.col("_fail").isNull()).drop("_fail")
    counts = marked.agg(*[F.count_if(F.col("_fail") == i).alias(f"_{i}") for i in range(len(rules))])
    rows = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("rule"), F.col(f"_{i}").alias("removed")) for i, (n, _) in enumerate(rules)])
    return kept, counts.select(F.explode(rows).alias("r")).select("r.*")


def popularity(reviews: Column | str, rating: Column | str) -> Column:
    return (F.col(reviews) if isinstance(reviews, str) else reviews) * (F.col(rating) if isinstance(rating, str) else rating)


def goal_score(text_columns: Sequence[str], words: Sequence[str], popular: Column) -> Column:
    """20 points per wanted word in any of the columns, plus popularity / 10000 up to 10."""
    low = [F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in text_columns]
    hits = [F.when(reduce(lambda a, b: a | b, [F.contains(t, F.lit(w.lower())) for t in low]), 20.0).otherwise(0.0) for w in words]
    return reduce(lambda a, b: a + b, hits, F.lit(0.0)) + F.least(popular / 10000.0, F.lit(10.0))


def recommend(
    df: DataFrame, key: str, text_columns: Sequence[str], popular: str, goals: Mapping[str, Sequence[str]], k: int
) -> DataFrame:
    """Per goal, in order, the ``k`` best products not yet taken by an earlier goal.

    Earlier goals can take at most ``k`` products each, so the best
    ``k * len(goals)`` of a goal always hold its picks. That handful is cut out
    per task, and the greedy choice runs over it inside one expression.
    """
    names = list(goals)
    scored = F.array(
        *[F.struct(F.lit(i).alias("goal_no"), F.lit(g).alias("goal"), goal_score(text_columns, w, F.col(popular)).alias("score")) for i, (g, w) in enumerate(goals.items())]
    )
    long = df.select(F.col(key).alias("item"), F.explode(scored).alias("g")).select("item", "g.*")
    order = [F.desc("score"), F.asc("item")]
    short = top_n_per_group(long, ["goal_no"], order, k * len(names), rank="_place")
    one = short.agg(F.array_sort(F.collect_list(F.struct("goal_no", "_place", "goal", "item", "score"))).alias("_c"))
    taken = F.expr(
        f"""aggregate(sequence(0, {len(names) - 1}), slice(_c, 1, 0), (done, i) -> concat(done, slice(filter(_c,
        x -> x.goal_no = i and not exists(done, y -> y.item = x.item)), 1, {k})))"""
    )
    picks = one.select(F.posexplode(taken).alias("_pos", "p")).select("p.goal_no", "p.goal", F.col("p.item").alias(key), "p.score", "_pos")
    return picks.withColumnRenamed("_pos", "pick").withColumn("score", F.bround("score", 6))


def weighted_rank(df: DataFrame, score: str, preferred: Column, order: str, k: int, weight: float = 2.5, out: str = "weighted") -> DataFrame:
    """Top ``k`` by the score, multiplied for preferred rows."""
    boost = F.when(F.coalesce(preferred, F.lit(False)), F.lit(weight)).otherwise(F.lit(1.0))
    return df.withColumn(out, F.bround(F.col(score) * boost, 6)).orderBy(F.desc(out), F.asc(order)).limit(k)


def basket_totals(items: DataFrame, basket: str, price: str, daily: str, scale: int = 2) -> DataFrame:
    """Items, price and daily cost per basket."""
    return items.groupBy(basket).agg(
        F.count(F.lit(1)).alias("items"), F.bround(F.sum(price), scale).alias("price"), F.bround(F.sum(daily), scale).alias("daily_cost")
    )


def basket_alerts(items: DataFrame, basket: str, ingredient: str, ignore: str | None = None) -> DataFrame:
    """Ingredients that occur more than once in a basket."""
    base = items if ignore is None else items.where(F.col(ingredient) != ignore)
    return base.groupBy(basket, ingredient).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def daily_cost(price: Column | str, text: Column | str, days: str, months: str, pieces: str) -> Column:
    """Cost per day from the pack size written in a product name, cut to a whole number.

    ``days``, ``months`` and ``pieces`` are regex alternatives for the units. A
    duration wins; else a count of ten or more at two pieces a day; else a month.
    """
    p = (F.col(price) if isinstance(price, str) else price).cast("double")
    number, unit = num_unit(text, rf"(\d+)\s*({months}|{days})")
    length = F.when(F.rlike(unit, F.lit(rf"^(?:{months})$")), number * 30).otherwise(number)
    count, _ = num_unit(text, rf"(\d+)\s*({pieces})")
    per_day = F.when(length > 0, p / F.nullif(length, F.lit(0))).when(count >= 10, p / F.nullif(count / 2.0, F.lit(0.0))).otherwise(p / 30.0)
    return F.when(p <= 0, F.lit(0)).otherwise(per_day).cast("int")


def keyword_index(df: DataFrame, count: Column, out: str = "score", flag: str = "has_keyword") -> DataFrame:
    """A keyword score and whether it is above zero."""
    return df.withColumn(out, count).withColumn(flag, F.col(out) > 0)


