"""Queries: statistics and distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from millrace.operators import distributions as H, sketches as K, stats as S
from millrace.operators.joins import salted_join
from millrace.plans.registry import Tables, query, rnd
from millrace.session import scratch_path

LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def describe_sql(source: str, columns: list[str], key: str = "") -> str:
    parts = []
    for c in columns:
        v = f"({c}::double + 0.0)"
        quart = ", ".join(f"{rnd(f'quantile_cont({v}, {p})')} as {n}" for n, p in [("q1", 0.25), ("median", 0.5), ("q3", 0.75)])
        parts.append(
            f"""select {key + "," if key else ""} '{c}' as "column", count({c}) as n, {rnd(f'avg({v})')} as mean, {rnd(f'stddev_samp({v})')} as std,
            cast(min({v}) as double) as min, cast(max({v}) as double) as max, {quart} from {source} {f"group by {key}" if key else ""}"""
        )
    return " union all ".join(parts)


@query("sx_01_describe_numeric", describe_sql("lineitem", LINE_NUM))
def _(t: Tables):
    return S.describe_numeric(t.lineitem, LINE_NUM)


@query("sx_01_describe_numeric_select", describe_sql("lineitem", LINE_NUM))
def _(t: Tables):
    """With the distributed quantile selection that large inputs take."""
    return S.describe_numeric(t.lineitem, LINE_NUM)


@query("sx_02_describe_by", describe_sql("orders", ["o_totalprice", "o_custkey"], "o_orderstatus"))
def _(t: Tables):
    return S.describe_by(t.orders, "o_orderstatus", ["o_totalprice", "o_custkey"])


ADVANCED_SQL = f"""
  with q as (select event_type, quantile_cont(value, 0.25) as q1, median(value) as median, quantile_cont(value, 0.75) as q3 from events group by 1),
  f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence, q3 + 1.5 * (q3 - q1) as upper_fence from q),
  o as (select event_type, count_if(value < lower_fence or value > upper_fence) as outliers from events join f using (event_type) group by 1),
  c as (select event_type, value, count(*) as n from events group by all),
  m as (select event_type, first(value order by n desc, value) as mode from c group by 1)
  select e.event_type, count(value) as n, {rnd('avg(value)')} as mean, {rnd('stddev_samp(value)')} as std, {rnd('skewness(value)')} as skew,
    {rnd('kurtosis(value)')} as kurtosis, {rnd('stddev_samp(value) / avg(value)')} as cv, min(value) as min, max(value) as max, any_value(mode) as mode,
    {", ".join(f"{rnd(f'any_value({c})')} as {c}" for c in ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"])}, any_value(outliers) as outliers
  from events e join f using (event_type) join o using (event_type) join m using (event_type) group by 1"""


@query("sx_03_advanced_stats", ADVANCED_SQL)
def _(t: Tables):
    return S.advanced_stats(t.events, "value", ["event_type"])


@query(
    "sx_04_population_moments",
    f"""select count(value) as n, {rnd('avg(value)')} as mean, {rnd('stddev_pop(value)')} as std,
        {rnd('skewness(value) * (count(value) - 2) / sqrt(count(value) * (count(value) - 1.0))')} as skew,
        {rnd('kurtosis_pop(value)')} as kurtosis, {rnd('stddev_pop(value) / avg(value)')} as cv from events""",
)
def _(t: Tables):
    return S.moments(t.events, "value", kind="population")


@query(
    "sx_05_sample_moments",
    f"""select l_suppkey, count(l_quantity) as n, {rnd('avg(l_quantity)')} as mean, {rnd('stddev_samp(l_quantity)')} as std, {rnd('skewness(l_quantity)')} as skew,
        {rnd('kurtosis(l_quantity)')} as kurtosis, {rnd('stddev_samp(l_quantity) / avg(l_quantity)')} as cv from lineitem group by 1""",
)
def _(t: Tables):
    return S.moments(t.lineitem, "l_quantity", ["l_suppkey"], "sample")


PROBS = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query("sx_06_quantiles", " union all ".join(f"select {p}::double as p, {rnd(f'quantile_cont(o_totalprice, {p})')} as value from orders" for p in PROBS))
def _(t: Tables):
    return S.quantile_table(t.orders, "o_totalprice", PROBS)


@query(
    "sx_06_quantiles_select",
    " union all ".join(f"select event_type, {p}::double as p, {rnd(f'quantile_cont(value, {p})')} as value from events group by 1" for p in PROBS),
)
def _(t: Tables):
    """With the distributed selection that large inputs take."""
    return S.quantile_table(t.events, "value", PROBS, ["event_type"])


@query(
    "sx_07_corr_matrix",
    " union all ".join(
        f"select '{a}' as x, '{b}' as y, {rnd(f'corr({a}, {b})') if a != b else 'any_value(1.0::double)'} as r from lineitem" for a in LINE_NUM for b in LINE_NUM
    ),
)
def _(t: Tables):
    return S.corr_matrix(t.lineitem, LINE_NUM)


@query(
    "sx_08_regression_pairs",
    " union all ".join(
        f"select '{x}' as x, '{y}' as y, {rnd(f'regr_slope({y}, {x})')} as slope, {rnd(f'regr_intercept({y}, {x})')} as intercept, {rnd(f'corr({x}, {y})')} as r from lineitem"
        for x, y in combinations(LINE_NUM, 2)
    ),
)
def _(t: Tables):
    return S.regression_pairs(t.lineitem, LINE_NUM)


WELCH_SQL = " union all ".join(
    f"""select '{c}' as "column", n1, n0, {rnd('m1 - m0')} as mean_diff, {rnd('(m1 - m0) / sqrt(v1 / n1 + v0 / n0)')} as t,
        {rnd('(v1 / n1 + v0 / n0) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v0 / n0) ** 2 / (n0 - 1))')} as dof from (
        select count({c}) filter (where l_returnflag = 'R') as n1, avg({c}) filter (where l_returnflag = 'R') as m1, var_samp({c}) filter (where l_returnflag = 'R') as v1,
        count({c}) filter (where l_returnflag <> 'R') as n0, avg({c}) filter (where l_returnflag <> 'R') as m0, var_samp({c}) filter (where l_returnflag <> 'R') as v0 from lineitem)"""
    for c in LINE_NUM
)


@query("sx_09_welch_t", WELCH_SQL)
def _(t: Tables):
    return S.welch_t(t.lineitem, F.col("l_returnflag") == "R", LINE_NUM, p_values=False)


def simpson(f: str, upper: str, table: str, keys: str, steps: int = 20_000) -> str:
    """SQL: integral of ``f`` (over x) from 0 to ``upper`` for each row of ``table``."""
    return f"""select {keys}, sum(h / 3 * case when i = 0 or i = {steps} then 1 when i % 2 = 1 then 4 else 2 end * ({f})) as area
        from (select *, {upper} / {steps} as h, {upper} / {steps} * i as x from {table}, range({steps + 1}) g(i)) group by all"""


T_PARTS = " union all ".join(
    f"""select '{c}' as "column", n1, n0, m1 - m0 as d, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) as t,
        (v1 / n1 + v0 / n0) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v0 / n0) ** 2 / (n0 - 1)) as k
        from (select count({c}) filter (r) as n1, count({c}) filter (not r) as n0, avg({c}) filter (r) as m1, avg({c}) filter (not r) as m0,
              var_samp({c}) filter (r) as v1, var_samp({c}) filter (not r) as v0 from (select *, l_returnflag = 'R' as r from lineitem))"""
    for c in LINE_NUM
)
T_DENSITY = "exp(lgamma((k + 1) / 2) - lgamma(k / 2)) / sqrt(k * pi()) * (1 + x * x / k) ** (-(k + 1) / 2)"


@query(
    "sx_09_welch_t_p",
    f"""with s as ({T_PARTS}), a as ({simpson(T_DENSITY, "least(abs(t), 40)", "s", '"column", n1, n0, d, t, k')})
        select "column", n1, n0, {rnd('d')} as mean_diff, {rnd('t')} as t, {rnd('k')} as dof, {rnd('greatest(1 - 2 * area, 0)')} as p_value, 1 - 2 * area < 0.05 as significant from a""",
)
def _(t: Tables):
    out = S.welch_t(t.lineitem, F.col("l_returnflag") == "R", LINE_NUM)
    return out.withColumn("p_value", F.bround("p_value", 6))


CHI_COLS = ["lang", "source", "quality"]
CHI_SQL = " union all ".join(
    f"""select '{c}' as "column", any_value(n) as n, any_value(dof) as dof, sum((gap - case when dof = 1 then least(0.5, gap) else 0 end) ** 2 / e) as chi2 from (
        select n, dof, e, abs(o - e) as gap from (
          select r.c * s.c * 1.0 / tot.n as e, tot.n as n, (nr - 1) * (nc - 1) as dof, coalesce(x.c, 0) as o
          from (select {c} as k, count(*) as c from d group by 1) r cross join (select toxic as k, count(*) as c from d group by 1) s
          cross join (select count(*) as n, count(distinct {c}) as nr, count(distinct toxic) as nc from d) tot
          left join (select {c} as a, toxic as b, count(*) as c from d group by all) x on x.a = r.k and x.b = s.k))"""
    for c in CHI_COLS
)
CHI_SQL = f"with d as (select lang, source, quality, toxic from documents join labels using (doc_id)), s as ({CHI_SQL})"


@query("sx_10_chi2", f"""{CHI_SQL} select "column", n, dof, {rnd('chi2')} as chi2 from s""")
def _(t: Tables):
    return S.chi2(t.documents.join(t.labels, "doc_id"), CHI_COLS, "toxic", p_values=False)


# with u = sqrt(x) the density has no pole at 0
CHI_DENSITY = "case when x = 0 then case when dof = 1 then sqrt(2 / pi()) else 0 end else exp((1 - dof / 2.0) * ln(2) - lgamma(dof / 2.0) + (dof - 1) * ln(x) - x * x / 2) end"


@query(
    "sx_10_chi2_p",
    f"""{CHI_SQL}, a as ({simpson(CHI_DENSITY, "sqrt(chi2)", "s", '"column", n, dof, chi2')})
        select "column", n, dof, {rnd('chi2')} as chi2, {rnd('greatest(1 - area, 0)')} as p_value, 1 - area < 0.05 as significant from a""",
)
def _(t: Tables):
    out = S.chi2(t.documents.join(t.labels, "doc_id"), CHI_COLS, "toxic")
    return out.withColumn("p_value", F.bround("p_value", 6))


def histogram_sql(source: str, v: str, bins: int, by: str = "", prob: bool = False) -> str:
    head = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return f"""with r as (select min({v}) as lo, (max({v}) - min({v})) / {bins} as w from {source}),
      b as (select {head} cast(least(floor(({v} - lo) / w), {bins - 1}) as int) as bin, count(*) as n, lo, w from {source}, r group by all)
      select {head} bin, n, {rnd('lo + w * bin')} as bin_start, {rnd('lo + w * (bin + 1)')} as bin_end
      {f", {rnd(f'n / sum(n) over ({part})')} as probability" if prob else ""} from b"""


@query("sx_11_histogram", histogram_sql("lineitem", "l_extendedprice", 50))
def _(t: Tables):
    return H.histogram(t.lineitem, "l_extendedprice", 50)


@query("sx_12_log_histogram", histogram_sql("events", "ln(1 + value)", 20))
def _(t: Tables):
    return H.log_histogram(t.events, "value", 20)


@query("sx_13_class_histogram", histogram_sql("events", "value", 25, "event_type", True))
def _(t: Tables):
    return H.histogram(t.events, "value", 25, by="event_type", norm="probability")


@query(
    "sx_14_box_stats",
    f"""with q as (select p_type, quantile_cont(p_retailprice, 0.25) as q1, median(p_retailprice) as median, quantile_cont(p_retailprice, 0.75) as q3 from part group by 1)
        select p_type, min(p_retailprice) as min, max(p_retailprice) as max, min(p_retailprice) filter (where inside) as whisker_low,
          max(p_retailprice) filter (where inside) as whisker_high, count_if(not inside) as outliers, {rnd('any_value(q1)')} as q1, {rnd('any_value(median)')} as median,
          {rnd('any_value(q3)')} as q3
        from (select *, p_retailprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from part join q using (p_type)) group by 1""",
)
def _(t: Tables):
    return S.box_stats(t.part, "p_retailprice", ["p_type"])


KDE_SQL = f"""with s as (select event_type, count(*) as n, stddev_samp(value) * count(*) ** (-0.2) as h from events group by 1),
  r as (select min(value) as lo, max(value) as hi from events),
  g as (select unnest(range(0, 40)) as point),
  c as (select event_type, value, count(*) as c from events group by all)
  select event_type, cast(point as int) as point, {rnd('any_value(lo + point * (hi - lo) / 39)')} as x,
    {rnd('sum(exp(-0.5 * ((lo + point * (hi - lo) / 39 - value) / h) ** 2) * c) / any_value(n * h * sqrt(2 * pi()))', 8)} as density
  from c join s using (event_type), r, g group by event_type, point"""


@query("sx_15_kde", KDE_SQL)
def _(t: Tables):
    return H.kde(t.events, "value", 40, by="event_type")


@query(
    "sx_16_band_table",
    f"""with b as (select case when o_totalprice < 50000 then 0 when o_totalprice < 150000 then 1 when o_totalprice < 300000 then 2 else 3 end as band,
          count(*) as n, avg(o_custkey) as m from orders group by 1)
        select cast(band as int) as band, ['under 50k', '50k-150k', '150k-300k', '300k up'][band + 1] as label, n, {rnd('n * 100.0 / sum(n) over ()')} as pct,
          {rnd('sum(n) over (order by band) * 100.0 / sum(n) over ()')} as cum_pct, {rnd('m')} as avg_metric from b""",
)
def _(t: Tables):
    return H.band_table(t.orders, "o_totalprice", [50000, 150000, 300000], ["under 50k", "50k-150k", "150k-300k", "300k up"], "o_custkey")


def profile_sql() -> str:
    rows = []
    for c, numeric in [("value", True), ("user_id", True), ("event_type", False)]:
        nums = (
            f"""{rnd(f'avg({c})')} as mean, {rnd(f'stddev_samp({c})')} as std, cast(min({c}) as double) as min, cast(max({c}) as double) as max,
            {rnd(f'quantile_cont({c}, 0.25)')} as q1, {rnd(f'median({c})')} as median, {rnd(f'quantile_cont({c}, 0.75)')} as q3, count_if({c} = 0) as zeros"""
            if numeric
            else "null as mean, null as std, null as min, null as max, null as q1, null as median, null as q3, null as zeros"
        )
        rows.append(
            f"""select '{c}' as "column", count(*) as rows, count_if({c} is null) as nulls, count(distinct {c}) as "unique",
            (select cast({c} as varchar) from events group by {c} order by count(*) desc, cast({c} as varchar) limit 1) as top,
            (select count(*) from events group by {c} order by count(*) desc limit 1) as freq, {nums}, '{"numeric" if numeric else "categorical"}' as kind from events"""
        )
    return " union all ".join(rows)


@query("sx_17_profile", profile_sql())
def _(t: Tables):
    return S.profile(t.events, ["value", "user_id"], ["event_type"])


def daily_sketches(t: Tables):
    """Sketches of every day and event type, written once."""
    path = scratch_path(t.spark, "sketches")
    events = t.events.select(F.to_date("ts").alias("day"), "event_type", "user_id", "value")
    K.sketched(events, ["value", "user_id"], ["event_type"], ["day", "event_type"]).write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "sx_17_profile_sketched",
    " union all ".join(
        f"""select '{c}' as "column", count(*) as rows, count_if({c} is null) as nulls, {f"cast(min({c}) as double)" if c != "event_type" else "null::double"} as min,
          {rnd(f"avg({c})") if c != "event_type" else "null::double"} as mean, true as distinct_near, true as top_near from events"""
        for c in ["value", "user_id", "event_type"]
    ),
)
def _(t: Tables):
    """A profile from merged sketches of days, its errors held against the exact one."""
    near = K.estimates(K.merged(daily_sketches(t).drop("event_type")))
    exact = S.describe_categorical(t.events, ["value", "user_id", "event_type"]).select("column", "unique", F.col("freq").alias("_most"))
    distinct = F.abs(F.col("distinct") - F.col("unique")) <= F.col("unique") * K.distinct_error()
    # no value is as frequent, or the one named is nearly as frequent as the first
    top = F.abs(F.coalesce("freq", F.lit(0)) - F.col("_most")) <= 2 * K.frequency_error() * F.col("rows")
    return near.join(exact, "column").select("column", "rows", "nulls", "min", "mean", distinct.alias("distinct_near"), top.alias("top_near"))


@query("ag_06_five_number_sketched", "select event_type, count(value) as n, min(value) as min, max(value) as max, true as q1_near, true as median_near, true as q3_near from events group by 1")
def _(t: Tables):
    """Five numbers by type from sketches of days, their ranks held against the rows."""
    days = daily_sketches(t).where(F.col("column") == "value")
    five = K.estimates(K.merged(days, ["event_type"]), ["event_type"]).select("event_type", "min", "q1", "median", "q3", "max")
    rows = salted_join(t.events.select("event_type", "value", "event_id").where("value is not null"), five, ["event_type"], "event_id")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    ranks = rows.groupBy("event_type", *five.columns[1:]).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("value") < F.col(q)).alias(f"_b_{q}") for q in probs], *[F.count_if(F.col("value") <= F.col(q)).alias(f"_u_{q}") for q in probs]
    )
    slack = F.col("n") * K.rank_error()
    near = [((F.col(f"_b_{q}") <= F.col("n") * p + slack) & (F.col(f"_u_{q}") >= F.col("n") * p - slack)).alias(f"{q}_near") for q, p in probs.items()]
    return ranks.select("event_type", "n", "min", "max", *near)


@query(
    "sx_18_shape_label",
    """select l_suppkey, case when s > 1 then 'right-skewed' when s < -1 then 'left-skewed' else 'even' end as side,
       case when k > 3 then 'peaked' else 'gentle' end as tail
       from (select l_suppkey, round_even(skewness(v), 6) as s, round_even(kurtosis(v), 6) as k
             from (select l_suppkey, case l_suppkey % 2 when 0 then 1 else -1 end * pow(l_quantity / 10, 1 + l_suppkey % 6) as v from lineitem) group by 1)""",
)
def _(t: Tables):
    # powers of the quantity, half of them turned, reach all labels
    power = F.pow(F.col("l_quantity") / 10, (1 + F.col("l_suppkey") % 6).cast("double"))
    values = t.lineitem.select("l_suppkey", F.when(F.col("l_suppkey") % 2 == 0, power).otherwise(-power).alias("v"))
    m = S.moments(values, "v", ["l_suppkey"], "sample")
    side, tail = S.shape_label(F.col("skew"), F.col("kurtosis"))
    return m.select("l_suppkey", side.alias("side"), tail.alias("tail"))
