"""Queries: aggregation, windows, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import aggregates as A, crosstabs as X, ordering as O
from millrace.plans.registry import Tables, query, rnd

FLAGS = ["R", "A", "N"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("ag_01_group_mean", f"select event_type, cast(hour(ts) as int) as hour, {rnd('avg(value)', 8)} as mean from events group by all")
def _(t: Tables):
    return A.group_mean(t.events.withColumn("hour", F.hour("ts")), ["event_type", "hour"], "value", scale=8)


@query("ag_02_group_sum", f"select l_suppkey, l_returnflag, {rnd('sum(l_extendedprice)', 2)} as total from lineitem group by all")
def _(t: Tables):
    return A.group_sum(t.lineitem, ["l_suppkey", "l_returnflag"], "l_extendedprice")


@query(
    "ag_03_group_agg",
    f"select p_type, p_brand, count(p_partkey) as n, {rnd('avg(p_retailprice)')} as avg_price, cast(sum(p_size) as bigint) as size from part group by all",
)
def _(t: Tables):
    specs = {"n": F.count("p_partkey"), "avg_price": F.bround(F.avg("p_retailprice"), 6), "size": F.sum("p_size")}
    return A.group_agg(t.part, ["p_type", "p_brand"], specs).orderBy(F.desc("n"), "p_type", "p_brand")


@query(
    "ag_04_group_summary",
    f"""select event_type, count(value) as n, {rnd('avg(value)')} as mean, {rnd('median(value)')} as median, {rnd('stddev_samp(value)')} as std,
        min(value) as min, max(value) as max from events group by 1""",
)
def _(t: Tables):
    return A.group_summary(t.events, ["event_type"], "value")


@query(
    "ag_05_flag_counts",
    """select p_type, p_brand, count_if(contains(p_name, 'red')) as red, count_if(contains(p_name, 'widget')) as widget,
       count_if(p_size > 25) as big, count(*) as total from part group by all""",
)
def _(t: Tables):
    flags = {"red": F.contains("p_name", F.lit("red")), "widget": F.contains("p_name", F.lit("widget")), "big": F.col("p_size") > 25}
    return A.flag_counts(t.part, ["p_type", "p_brand"], flags).orderBy("p_type", "p_brand")


FIVE = ", ".join(
    f"{rnd(f'quantile_cont(l_extendedprice, {p})')} as {n}" for n, p in [("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0)]
)


@query("ag_06_five_number", f"select l_returnflag, {FIVE} from lineitem group by 1")
def _(t: Tables):
    return A.five_number(t.lineitem, ["l_returnflag"], "l_extendedprice")


@query("ag_06_five_number_select", f"select l_returnflag, {FIVE} from lineitem group by 1")
def _(t: Tables):
    """The same through the distributed selection that large inputs take."""
    return A.five_number(t.lineitem, ["l_returnflag"], "l_extendedprice")


@query("ag_07_group_median", f"select c_nationkey, {rnd('median(c_acctbal)')} as c_acctbal, {rnd('median(c_custkey)')} as c_custkey from customer group by 1")
def _(t: Tables):
    return A.group_median(t.customer, ["c_nationkey"], ["c_acctbal", "c_custkey"])


@query(
    "ag_08_group_mode",
    """with c as (select l_suppkey, l_quantity, count(*) as n from lineitem group by all)
       select l_suppkey, l_quantity as mode from (select *, row_number() over (partition by l_suppkey order by n desc, l_quantity) as rn from c) where rn = 1""",
)
def _(t: Tables):
    return A.group_mode(t.lineitem, ["l_suppkey"], "l_quantity")


@query("ag_09_group_first", "select user_id, arg_min(value, event_id) as first from events where event_type <> 'error' group by 1")
def _(t: Tables):
    holes = t.events.withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return A.group_first(holes, "user_id", "v", F.col("event_id"))


@query("ag_10_value_counts", "select p_name, count(*) as n from part group by 1 order by n desc, p_name limit 20")
def _(t: Tables):
    return A.value_counts(t.part, "p_name", 20)


@query(
    "ag_10_value_counts_pct",
    f"select o_orderpriority, count(*) as n, {rnd('count(*) * 100.0 / (select count(*) from orders)')} as pct from orders group by 1",
)
def _(t: Tables):
    return A.value_counts(t.orders, "o_orderpriority", share=True)


@query("ag_10_value_counts_null", "select nullif(o_orderstatus, 'P') as s, count(*) as n from orders group by 1")
def _(t: Tables):
    return A.value_counts(t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("s")), "s", dropna=False)


@query(
    "ag_11_grouping_sets",
    f"""select coalesce(event_type, 'all') as event_type, coalesce(cast(hour(ts) as varchar), 'all') as hour, count(value) as n, {rnd('avg(value)')} as mean
        from events group by grouping sets ((event_type, hour(ts)), (event_type), (hour(ts)), ())""",
)
def _(t: Tables):
    rows = t.events.withColumn("hour", F.hour("ts"))
    return A.grouping_sets(rows, [["event_type", "hour"], ["event_type"], ["hour"], []], "value", "all")


CROSS = ", ".join(f"count_if(l_returnflag = '{v}') as {v}" for v in FLAGS)


LISTED = ", ".join(f"count_if(l_returnflag = '{v}') as {v}" for v in FLAGS[:2])  # the third only counts in the totals


@query(
    "ag_12_crosstab",
    f"""select coalesce(cast(l_suppkey as varchar), 'total') as supplier, {LISTED}, count(*) as total from lineitem group by rollup (l_suppkey)""",
)
def _(t: Tables):
    rows = t.lineitem.select(F.col("l_suppkey").cast("string").alias("supplier"), "l_returnflag")
    return X.crosstab(rows, "supplier", "l_returnflag", FLAGS[:2], margins=True)


@query(
    "ag_13_crosstab_pct",
    f"""select lang, {rnd('count_if(quality = 1) * 100.0 / count(*)')} as "1", {rnd('count_if(quality = 0) * 100.0 / count(*)')} as "0", 0.0 as "9"
        from documents join labels using (doc_id) group by 1""",
)
def _(t: Tables):
    return X.crosstab_pct(t.documents.join(t.labels, "doc_id"), "lang", "quality", [1, 0, 9])


@query(
    "ag_14_flag_crosstab",
    """select coalesce(p_type, 'total') as p_type, cast(sum(red) as bigint) as red, cast(sum(widget) as bigint) as widget, cast(sum(red + widget) as bigint) as total
       from (select coalesce(nullif(p_type, 'PROMO'), 'unknown') as p_type, cast(contains(p_name, 'red') as int) as red, cast(contains(p_name, 'widget') as int) as widget from part)
       group by rollup (p_type) having sum(red + widget) > 0""",
)
def _(t: Tables):
    rows = t.part.select(F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "p_name")
    flags = {"red": F.contains("p_name", F.lit("red")), "widget": F.contains("p_name", F.lit("widget"))}
    return X.flag_crosstab(rows, "p_type", flags, missing="unknown")


@query(
    "ag_15_pivot_mean",
    "select event_type, "
    + ", ".join(f'{rnd(f"avg(value) filter (where hour(ts) = {h})")} as "{h}"' for h in range(24))
    + " from events group by 1",
)
def _(t: Tables):
    return X.pivot_mean(t.events.withColumn("hour", F.hour("ts")), "event_type", "hour", "value", list(range(24)), ["view", "click", "signup", "purchase"])


@query(
    "ag_16_with_totals",
    """with c as (select p_brand, count_if(p_size > 25) as big, count_if(p_size <= 25) as small from part group by 1)
       select p_brand, big, small, big + small as total from c union all
       select 'total', cast(sum(big) as bigint), cast(sum(small) as bigint), cast(sum(big + small) as bigint) from c""",
)
def _(t: Tables):
    counts = t.part.groupBy("p_brand").agg(F.count_if(F.col("p_size") > 25).alias("big"), F.count_if(F.col("p_size") <= 25).alias("small"))
    return X.with_totals(counts, "p_brand", ["big", "small"])


@query(
    "ag_17_kpis",
    f"""select count(*) as n, count_if(o_orderstatus = 'F') as positives, {rnd("count_if(o_orderstatus = 'F') * 100.0 / count(*)")} as conversion_pct,
        {rnd('avg(o_totalprice)')} as mean_value from orders""",
)
def _(t: Tables):
    return A.kpis(t.orders, F.col("o_orderstatus") == "F", "o_totalprice")


CAT_COLS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query(
    "ag_18_describe_categorical",
    f"""with l as ({" union all ".join(f"select '{c}' as column_name, cast({c} as varchar) as v, count(*) as n from orders group by 2" for c in CAT_COLS)})
        select column_name as "column", cast(sum(n) as bigint) as "count", count(*) as "unique", first(v order by n desc, v) as top, max(n) as freq from l group by 1""",
)
def _(t: Tables):
    return A.describe_categorical(t.orders, CAT_COLS)


LINE_KEYS = {"line": ["l_orderkey", "l_linenumber"], "part": ["l_orderkey", "l_partkey"], "supplier": ["l_suppkey", "l_shipdate", "l_quantity"]}


@query(
    "ag_19_duplicate_report",
    " union all ".join(
        f"""select '{n}' as key_set, cast(sum(n) as bigint) as rows, cast(sum(case when n > 1 then n else 0 end) as bigint) as duplicate_rows,
            cast(sum(n - 1) as bigint) as surplus_rows from (select count(*) as n from lineitem group by {", ".join(k)})"""
        for n, k in LINE_KEYS.items()
    ),
)
def _(t: Tables):
    return A.duplicate_report(t.lineitem, LINE_KEYS)


@query(
    "ag_19_duplicate_samples",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1 order by n desc, l_orderkey, l_linenumber limit 10",
)
def _(t: Tables):
    return A.duplicate_samples(t.lineitem, ["l_orderkey", "l_linenumber"], 10)


@query(
    "ag_20_null_report",
    f"""with r as (select nullif(o_orderstatus, 'P') as o_orderstatus, nullif(o_orderpriority, '5-LOW') as o_orderpriority, o_custkey from orders)
        {" union all ".join(f"select '{c}' as column, count_if({c} is null) as nulls, count(*) as rows, {rnd(f'count_if({c} is null) * 100.0 / count(*)')} as null_pct from r" for c in ["o_orderstatus", "o_orderpriority", "o_custkey"])}""",
)
def _(t: Tables):
    holes = t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_custkey")
    return A.null_report(holes)


AG_21 = """select event_type, count(*) as n, {r}(avg(value), 6) as mean, min(value) as low, max(value) as high
           from events group by event_type order by n desc, event_type"""


@query("ag_21_sql", AG_21.format(r="round_even"))
def _(t: Tables):
    return t.spark.sql(AG_21.format(r="bround").replace("from events", "from {events}"), events=t.events)


@query("ag_22_ratio_of_sums", f"select l_suppkey, {rnd('sum(l_extendedprice) / nullif(sum(l_quantity), 0)')} as ratio from lineitem group by 1")
def _(t: Tables):
    return A.ratio_of_sums(t.lineitem, ["l_suppkey"], "l_extendedprice", "l_quantity")


@query("ag_23_daily_counts", "select cast(ts as date) as day, event_type, count(*) as n from events group by all")
def _(t: Tables):
    return A.daily_counts(t.events, "ts", "event_type")


@query("ag_24_row_sum", "select c_custkey, coalesce(nullif(c_nationkey, 3), 0) + c_custkey as s from customer")
def _(t: Tables):
    return t.customer.select("c_custkey", C.row_sum([F.nullif("c_nationkey", F.lit(3)), "c_custkey"]).alias("s"))


@query(
    "ag_25_mean_of_means",
    f"select event_type, {rnd('avg(m)')} as mean from (select event_type, user_id, avg(value) as m from events group by all) group by 1",
)
def _(t: Tables):
    return A.mean_of_means(t.events, ["event_type", "user_id"], ["event_type"], "value")


@query(
    "ag_26_compare_by_flag",
    f"select contains(p_name, 'red') as flag, count(*) as n, {rnd('avg(p_retailprice)')} as avg_p_retailprice, {rnd('avg(p_size)')} as avg_p_size from part group by 1",
)
def _(t: Tables):
    return A.compare_by_flag(t.part, F.contains("p_name", F.lit("red")), ["p_retailprice", "p_size"])


@query(
    "ag_27_source_matrix",
    """with s as (select c_nationkey as k, 'customer' as source from customer union all select s_nationkey, 'supplier' from supplier)
       select g.k, d.source, count(s.k) as n from (select unnest(list_append(range(25), 77)) as k) g cross join (select unnest(['customer', 'supplier']) as source) d
       left join s on s.k = g.k and s.source = d.source group by all""",
)
def _(t: Tables):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    return A.source_matrix({"customer": a, "supplier": b}, "k", [*range(25), 77])


@query(
    "ag_28_share",
    f"with c as (select p_type, count(*) as n from part group by 1) select p_type, n, {rnd('n * 100.0 / sum(n) over ()')} as pct from c",
)
def _(t: Tables):
    return A.share(t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")), "p_type", "n")


@query(
    "ag_29_join_text",
    """select p_partkey, case when not contains(p_name, 'red') and not contains(p_name, 'widget') then 'other'
       else concat_ws(',', case when contains(p_name, 'red') then 'red' end, case when contains(p_name, 'widget') then 'widget' end) end as labels from part""",
)
def _(t: Tables):
    marks = [F.when(F.contains("p_name", F.lit(w)), F.lit(w)) for w in ("red", "widget")]
    return t.part.select("p_partkey", C.join_text(marks, ",", "other").alias("labels"))


@query("ag_29_join_labels", "select user_id, string_agg(distinct event_type, ',' order by event_type) as labels from events group by 1")
def _(t: Tables):
    return A.join_labels(t.events, ["user_id"], "event_type")


# ------------------------------------------------------------------ windows


@query(
    "wn_01_flag_top",
    """select event_id, user_id, value, row_number() over (partition by user_id order by value desc, event_id) = 1 as is_top from events""",
)
def _(t: Tables):
    return O.flag_top(t.events.select("event_id", "user_id", "value"), "user_id", "value", "event_id")


@query(
    "wn_02_top_n_per_group",
    f"""with c as (select p_type, p_name, count(*) as n, {rnd('sum(p_retailprice)', 2)} as revenue, cast(sum(p_size) as bigint) as size from part group by all)
        select * from (select *, row_number() over (partition by p_type order by size desc, p_name) as rank from c) where rank <= 3""",
)
def _(t: Tables):
    agg = t.part.groupBy("p_type", "p_name").agg(F.count(F.lit(1)).alias("n"), F.bround(F.sum("p_retailprice"), 2).alias("revenue"), F.sum("p_size").alias("size"))
    return O.top_n_per_group(agg, ["p_type"], [F.desc("size"), F.asc("p_name")], 3, "rank")


PARETO = f"""with c as (select l_partkey, count(*) as n from lineitem group by 1),
  r as (select l_partkey, n, {rnd('sum(n) over (order by n desc, l_partkey rows unbounded preceding) * 100.0 / (select count(*) from lineitem)')} as cum_pct from c)
  select * from r"""


@query("wn_03_pareto", f"{PARETO} where cum_pct <= 80")
def _(t: Tables):
    return O.pareto(t.lineitem, "l_partkey", 80.0)


@query("wn_03_pareto_ranges", PARETO)
def _(t: Tables):
    """The same through range pieces, as large inputs take it."""
    return O.pareto(t.lineitem, "l_partkey")


@query(
    "wn_04_drop_duplicates",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey, l_linenumber
       order by l_partkey, l_suppkey) as rn from lineitem) where rn = 1""",
)
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return O.drop_duplicates(rows, ["l_orderkey", "l_linenumber"], [F.asc("l_partkey"), F.asc("l_suppkey")])


@query(
    "wn_05_extremes",
    """select * from (select o_orderkey, o_totalprice, 'max' as extreme from orders order by o_totalprice desc, o_orderkey limit 1)
       union all select * from (select o_orderkey, o_totalprice, 'min' from orders order by o_totalprice, o_orderkey limit 1)""",
)
def _(t: Tables):
    return O.extremes(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query(
    "wn_06_step_change",
    f"""with d as (select cast(ts as date) as day, event_type, count(*) as n from events group by all)
        select day, event_type, n, lag(n) over w as previous, first_value(n) over w as first, n - lag(n) over w as change,
        {rnd('(n - lag(n) over w) * 100.0 / nullif(lag(n) over w, 0)')} as change_pct from d window w as (partition by event_type order by day)""",
)
def _(t: Tables):
    return O.step_change(A.daily_counts(t.events, "ts", "event_type"), ["event_type"], "day", "n")


# ----------------------------------------------------------- sort and sample


@query("st_01_sort", "select l_suppkey, l_returnflag, count(*) as n from lineitem group by all order by l_suppkey, n desc, l_returnflag")
def _(t: Tables):
    counts = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("l_suppkey", F.desc("n"), "l_returnflag")


@query("st_02_top_k", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey limit 25")
def _(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return O.top_k(t.lineitem.select(*keys, "l_extendedprice"), [F.desc("l_extendedprice"), *[F.asc(k) for k in keys]], 25)


@query("st_03_latest_n", "select event_id, ts, user_id, event_type from events order by ts desc, event_id desc limit 20")
def _(t: Tables):
    return O.top_k(t.events.select("event_id", "ts", "user_id", "event_type"), [F.desc("ts"), F.desc("event_id")], 20)


@query(
    "st_04_sample_frac",
    "select event_id, user_id, value from events where cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 1000 < 50",
)
def _(t: Tables):
    return O.sample_frac(t.events.select("event_id", "user_id", "value"), ["event_id"], 50)


@query("st_05_sample_n", "select o_orderkey, o_totalprice from orders order by md5(cast(o_orderkey as varchar)), o_orderkey limit 500")
def _(t: Tables):
    return O.sample_n(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500)


@query("st_05_sample_n_cutoff", "select o_orderkey, o_totalprice from orders order by md5(cast(o_orderkey as varchar)), o_orderkey limit 2000")
def _(t: Tables):
    """With the digest cut-off that large samples take."""
    return O.sample_n(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 2000)


@query("st_06_first_keys", "select distinct user_id from events order by 1 limit 50")
def _(t: Tables):
    return O.first_keys(t.events, "user_id", 50)
