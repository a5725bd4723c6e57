"""Statistics against textbook values and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.pvalues import chi2_tail, t_two_sided
from millrace.operators import distributions as H, stats as S
from millrace.operators.quantiles import quantiles


def test_t_table():
    # two-sided 5 % points of Student's t
    for t, df in [(12.7062, 1), (4.3027, 2), (2.5706, 5), (2.2281, 10), (2.0423, 30), (1.9840, 100)]:
        assert t_two_sided(t, df) == pytest.approx(0.05, abs=2e-5)
    assert t_two_sided(0.0, 7) == pytest.approx(1.0)
    assert t_two_sided(-2.2281, 10) == pytest.approx(0.05, abs=2e-5)


def test_chi2_table():
    # 5 % and 1 % points of the chi-square distribution
    for x, k, p in [(3.8415, 1, 0.05), (5.9915, 2, 0.05), (18.307, 10, 0.05), (6.6349, 1, 0.01), (23.209, 10, 0.01), (124.342, 100, 0.05)]:
        assert chi2_tail(x, k) == pytest.approx(p, abs=2e-5)
    assert chi2_tail(0.0, 3) == 1.0


def skewed(n=4000):
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.lognormal(3, 2, n), -rng.lognormal(0, 3, n // 2), np.full(n, 5.0), np.exp(-rng.uniform(2, 700, 300)), [5e-324, 0.0, -0.0, 1e300, -1e300, 1e-300]])
    g = np.where(np.arange(len(v)) % 3 == 0, "hot", np.char.add("g", (np.arange(len(v)) % 7).astype(str)))
    return [(str(a), float(b)) for a, b in zip(g, v)]


PROBS = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]


def test_selection_equals_numpy(spark):
    rows = skewed()
    df = spark.createDataFrame(rows + [("hot", None), ("g1", float("nan")), (None, 3.0), (None, 4.0)], "g string, v double").repartition(7)
    for by in ([], ["g"]):
        got = {r["g"] if by else "": r["q"] for r in quantiles(df, "v", PROBS, by).collect()}
        known = df.where("v is not null and not isnan(v)")
        agg = {r["g"] if by else "": r["q"] for r in known.groupBy(*by).agg(F.percentile("v", F.array(*map(F.lit, PROBS))).alias("q")).collect()}
        assert got.keys() == agg.keys()
        for k in got:
            assert got[k] == pytest.approx(agg[k], rel=1e-12)
    hot = [v for g, v in rows if g == "hot"]
    assert {r["g"]: r["q"] for r in quantiles(df, "v", PROBS, ["g"]).collect()}["hot"] == pytest.approx(np.quantile(hot, PROBS).tolist())


def test_selection_on_one_value_and_on_nothing(spark):
    df = spark.createDataFrame([(7.0,)] * 5, "v double")
    assert quantiles(df, "v", [0.1, 0.5]).first()["q"] == [7.0, 7.0]
    assert quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_selection_with_infinities_and_crowded_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 5.0, inf)], "v double")
    assert quantiles(df, "v", [0.25, 0.5, 1.0]).first()["q"] == [1.75, 3.5, inf]
    df = spark.createDataFrame([(x,) for x in (-inf, -inf, 0.0, -0.0, 5e-324, inf, inf, inf)], "v double")
    assert quantiles(df, "v", [0.0, 0.1, 0.5, 1.0]).first()["q"][:2] == [-inf, -inf]
    # many values within 1e-9 of each other beside a far one in the same first cell
    near = spark.range(200_000).select((F.lit(1.0) + F.col("id") * 2.0**-52).alias("v")).unionByName(spark.createDataFrame([(1.0155,)], "v double"))
    values = np.append(1.0 + np.arange(200_000) * 2.0**-52, 1.0155)
    assert quantiles(near, "v", [0.3, 0.5, 0.9]).first()["q"] == pytest.approx(np.quantile(values, [0.3, 0.5, 0.9]).tolist(), abs=1e-16)


def test_sample_moments_need_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), ("b", 9.0)], "g string, v double")
    got = {r["g"]: r for r in S.moments(df, "v", ["g"], "sample").collect()}
    assert got["a"]["skew"] is None and got["a"]["kurtosis"] is None
    assert got["b"]["skew"] is not None and got["b"]["kurtosis"] is None


def test_chi2_yates_with_an_empty_cell(spark):
    # 2 x 2 table 10 20 / 30 0: textbook Yates statistic n(|ad - bc| - n/2)^2 / (r1 r2 c1 c2)
    rows = [("x", "0")] * 10 + [("x", "1")] * 20 + [("y", "0")] * 30
    df = spark.createDataFrame(rows, "c string, t string")
    got = S.chi2(df, ["c"], "t").first()
    assert got["dof"] == 1 and got["chi2"] == pytest.approx(60 * (600 - 30) ** 2 / (30 * 30 * 40 * 20), abs=1e-6)
    assert got["significant"]


def test_chi2_with_empty_cells(spark):
    rows = [("x", "0")] * 10 + [("x", "1")] * 20 + [("y", "0")] * 30 + [("z", "2")] * 5
    o = np.array([[10, 20, 0], [30, 0, 0], [0, 0, 5.0]])
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    got = S.chi2(spark.createDataFrame(rows, "c string, t string"), ["c"], "t").first()
    assert got["dof"] == 4 and got["chi2"] == pytest.approx(((o - e) ** 2 / e).sum(), abs=1e-6)


def test_welch_without_one_side(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (3.0, True)], "v double, t boolean")
    got = S.welch_t(df, F.col("t"), ["v"]).first()
    assert got["n0"] == 0 and got["t"] is None and got["p_value"] is None


def test_histogram_ends(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    got = {r["bin"]: r["n"] for r in H.histogram(df, "v", 5).collect()}
    want, _ = np.histogram(np.arange(11.0), 5)
    assert got == {i: int(n) for i, n in enumerate(want)}
    flat = H.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 5).collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 3)]


def test_density_integrates_to_one(spark, folder):
    df = spark.read.parquet(f"{folder}/events.parquet").select(F.log1p("value").alias("v"))
    rows = sorted((r["x"], r["density"]) for r in H.kde(df, "v", 200).collect())
    x, d = np.array(rows).T
    assert np.trapezoid(d, x) == pytest.approx(1.0, abs=0.05)


@pytest.mark.parametrize("by", [None, "g"])
def test_density_by_cells_equals_the_sum_over_rows(spark, by):
    rng = np.random.default_rng(3)
    far = np.concatenate([rng.normal(0, 1, 300), rng.normal(1e6, 1e-3, 200), [-5e7, 1e9]])
    values = {"a": far, "b": rng.normal(5, 1e-30, 40), "c": np.array([7.0, 7.0]), "d": np.array([1.0]), "e": rng.exponential(3, 500)}
    rows = [(g, float(x)) for g, v in values.items() for x in v] + [("a", None), ("a", float("nan"))] + ([(None, 3.0)] if by else [])
    got = {}
    for r in H.kde(spark.createDataFrame(rows, "g string, v double"), "v", 30, by, 40).collect():
        got.setdefault(r[by] if by else None, {})[r.point] = r.density
    groups = values if by else {None: np.concatenate(list(values.values()))}
    everything = np.concatenate(list(values.values()))
    xs = np.linspace(everything.min(), everything.max(), 30)
    wanted = {g: v for g, v in groups.items() if len(v) > 1 and v.std() > 0}
    assert got.keys() == wanted.keys()
    for g, v in wanted.items():
        h = v.std(ddof=1) * len(v) ** -0.2
        d = np.exp(-0.5 * ((xs[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert [got[g][k] for k in range(30)] == pytest.approx(list(d), rel=1e-6, abs=1e-12 / h)


def test_density_work_per_row_does_not_depend_on_the_points(spark):
    df = spark.range(1000).select(F.rand(1).alias("v"))
    for points in (5, 500):
        lines = H.kde(df, "v", points)._jdf.queryExecution().optimizedPlan().toString().split("\n")
        sums = next(k for k, line in enumerate(lines) if "Aggregate" in line and "_t8" in line)
        assert "EXP(" in "".join(lines[:sums]) and "EXP(" not in "".join(lines[sums:])
