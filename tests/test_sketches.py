"""Sketches against exact results, within the errors they state."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import sketches as K


def data(seed, n=30_000):
    rng = random.Random(seed)
    values = [lambda: rng.gauss(50, 20), lambda: float(rng.randrange(40)), lambda: rng.expovariate(0.001), lambda: None, lambda: float("nan"), lambda: -0.0]
    return [(rng.randrange(6), rng.choice("ab"), rng.choice(values)(), rng.choice(["x", "x", "y", None, None, None, f"v{rng.randrange(9000)}"])) for _ in range(n)]


SCHEMA = "day int, g string, v double, c string"


@pytest.mark.parametrize("ranks,bits,tracked", [(K.RANKS, K.BUCKET_BITS, K.TRACKED), (200, 10, 300)])
def test_merged_days_stay_within_the_errors(spark, tmp_path, ranks, bits, tracked):
    rows = data(ranks)
    path = str(tmp_path / "days")
    df = spark.createDataFrame(rows, SCHEMA)
    K.sketched(df, ["v"], ["c"], ["day", "g"], ranks, bits, tracked).write.parquet(path)
    for by in (["g"], []):
        merged = K.merged(spark.read.parquet(path), by, ranks, tracked)
        probs = {f"p{k}": k / 20 for k in range(1, 20)}
        got = {(r.g if by else None, r.column): r for r in K.estimates(merged, by, probs).collect()}
        for group in ("a", "b") if by else (None,):
            own = [r for r in rows if group in (None, r[1])]
            v = sorted(x + 0.0 for *_, x, _ in own if x is not None and x == x)
            r = got[group, "v"]
            assert (r.rows, r.nulls, r.min, r.max) == (len(own), len(own) - len(v), v[0], v[-1]) and r.mean == pytest.approx(sum(v) / len(v), abs=1e-5)
            for name, p in probs.items():
                below, upto = sum(x < r[name] for x in v), sum(x <= r[name] for x in v)
                slack = K.rank_error(ranks) * len(v)
                assert below <= p * len(v) + slack and upto >= p * len(v) - slack
            assert r.distinct == pytest.approx(len(set(v)), rel=K.distinct_error(bits))
            c = Counter(x for *_, x in own if x is not None)
            r = got[group, "c"]
            assert (r.rows, r.nulls, r.min, r.mean, r.p5) == (len(own), len(own) - c.total(), None, None, None)
            assert r.distinct == pytest.approx(len(c), rel=K.distinct_error(bits))
            assert r.top == "x" and abs(r.freq - c["x"]) <= K.frequency_error(tracked) * c.total()


def test_one_scan(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"), F.col("id").cast("string").alias("c"))
    out = K.profile_sketched(df, ["v"], ["c"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Join" not in plan
    r = {r.column: r for r in out.collect()}["v"]
    assert (r.rows, r.min, r.max, r.median, r.distinct) == (100, 0.0, 99.0, 49.0, 100)


def test_nothing_to_see(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [(r.rows, r.nulls, r.q1, r.distinct, r.top) for r in K.profile_sketched(empty, ["v"], ["c"]).collect()] == [(0, 0, None, 0, None)] * 2
    assert K.sketched(empty, ["v"], [], ["g"]).collect() == []
    nulls = spark.createDataFrame([(1, None, None, None), (1, None, float("nan"), None)], SCHEMA)
    got = K.estimates(K.merged(K.sketched(nulls, ["v"], ["c"], ["g"]), ["g"]), ["g"]).collect()
    assert [(r.g, r.rows, r.nulls, r.mean, r.median, r.distinct, r.top, r.freq) for r in got] == [(None, 2, 2, None, None, 0, None, None)] * 2
