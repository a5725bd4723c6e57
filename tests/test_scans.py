"""How often operators read their rows, and that what they leave out changes nothing."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import quantiles as Q
from millrace.operators import tfidf as K


def values(seed, n=4000):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(100, 1), lambda: rng.gauss(-1e-9, 1e-9), lambda: 0.0, lambda: 5.0, lambda: rng.choice([1e300, -1e300, float("inf"), -float("inf")]), lambda: rng.uniform(1, 1.001), lambda: None, lambda: float("nan")]
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice(kinds)()) for _ in range(n)] + [("one", 3.5), ("none", None)]


def counted(spark, rows, schema):
    """A table that counts the rows read from it."""
    read = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, schema).mapInArrow(look, schema), read


@pytest.mark.parametrize("last,parts", [(65_536, 4096), (5, 4096), (5, 3)])
def test_quantiles_read_the_rows_twice(spark, monkeypatch, last, parts):
    monkeypatch.setattr(Q, "_LAST", last)
    monkeypatch.setattr(Q, "_PARTS", parts)
    rows, probs = values(last + parts), [0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0]
    df, read = counted(spark, rows, "g string, v double")
    got = {r.g: r.q for r in Q.quantiles(df, "v", probs, ["g"]).collect()}
    assert read.value <= 2 * len(rows)
    by = defaultdict(list)
    for g, v in rows:
        if v is not None and v == v:
            by[g].append(v)
    assert got.keys() == by.keys()
    for g, own in by.items():
        own.sort()
        for p, q in zip(probs, got[g]):
            at = p * (len(own) - 1)
            low, high = own[int(np.floor(at))], own[int(np.ceil(at))]
            want = low if low == high else low + (high - low) * (at - np.floor(at))
            assert q == want or np.isnan(want) and np.isnan(q)


def test_ends_need_one_read(spark):
    df, read = counted(spark, [(float(k),) for k in range(1000)], "v double")
    assert Q.quantiles(df, "v", [0.0, 1.0]).first().q == [0.0, 999.0]
    assert read.value == 1000


@pytest.mark.parametrize("controls", [{}, {"max_features": 5}, {"min_df": 2, "max_df": 0.5}, {"stop": ["a", "b"], "max_features": 4}])
def test_documents_of_several_rows(spark, controls):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y"]), rng.choice([1, 2, 3, None, 10 + k]), " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9)))) for k in range(60)] + [("x", 5, None)]
    df = spark.createDataFrame(rows, "g string, d long, t string")
    got = {(r.g, r.doc, r.term): (r.tf, r.df, round(r.weight, 9)) for r in K.tfidf(df, "d", "t", by=["g"], **controls).collect()}
    want = {}
    for g in ("x", "y"):
        docs, n = defaultdict(Counter), sum(r[0] == g for r in rows)
        for own, d, t in rows:
            if own == g:
                docs[d].update(w for w in (t or "").split() if w not in controls.get("stop", ()))
        df_, ttf = Counter(), Counter()
        for c in docs.values():
            df_.update(c.keys())
            ttf.update(c)
        terms = [t for t in df_ if df_[t] >= controls.get("min_df", 1) and df_[t] <= controls.get("max_df", 1.0) * n]
        terms = set(sorted(terms, key=lambda t: (-ttf[t], t))[: controls.get("max_features")])
        for d, c in docs.items():
            w = {t: k * (np.log((1 + n) / (1 + df_[t])) + 1) for t, k in c.items() if t in terms}
            norm = np.sqrt(sum(x * x for x in w.values()))
            want.update({(g, d, t): (c[t], df_[t], round(x / norm, 9)) for t, x in w.items()})
    assert got == want


def test_texts_are_not_shuffled(spark, tmp_path):
    spark.range(64).select(F.col("id").alias("d"), F.lit("some words").alias("t")).repartition(64).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    plan = K.tfidf(docs, "d", "t", max_features=3)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan
    for line in plan.split("\n"):
        assert not ("Exchange" in line and ("t#" in line.split("plan_id")[0] or "words#" in line))


def test_rows_that_are_documents_are_counted_where_they_are_read(spark, tmp_path):
    spark.range(64).select(F.col("id").alias("d"), F.lit("b a b").alias("t")).repartition(64).write.parquet(str(tmp_path / "t"))
    weights = K.tfidf(spark.read.parquet(str(tmp_path / "t")), "d", "t")
    assert {(r.term, r.tf) for r in weights.collect()} == {("a", 1), ("b", 2)}
    final = weights._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Final Plan" in final and "hashpartitioning(doc" in final
    assert "term" not in "".join(x.split(")")[0] for x in final.split("hashpartitioning(doc")[1:])
