"""Queries: rules, scores, funnels, marts, quality, streaming."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.operators import funnel as N, quality as Q, rules as R
from millrace.plans import marts as M
from millrace.plans.cat_sources import TIER_SQL, tier_sides
from millrace.plans.registry import Tables, query, rnd
from millrace.session import scratch_path
from millrace.streaming import ingest as I

# -------------------------------------------------------------------- rules

KIND_RULES = [R.Rule("ring", ("ring",)), R.Rule("warm", ("hot", "red")), R.Rule("rotary", ("gear", "gizmo")), R.Rule("sized", pattern=r"\b(small|large)\b")]
TEXT = "lower(p_name || ' ' || p_type)"
KIND_TESTS = [
    ("ring", f"contains({TEXT}, 'ring')"),
    ("warm", f"contains({TEXT}, 'hot') or contains({TEXT}, 'red')"),
    ("rotary", f"contains({TEXT}, 'gear') or contains({TEXT}, 'gizmo')"),
    ("sized", f"regexp_matches({TEXT}, '\\b(small|large)\\b')"),
]
KIND_CASE = "case " + " ".join(f"when {c} then '{n}'" for n, c in KIND_TESTS) + " else 'other' end"


@query("rl_01_classify", f"select p_partkey, {KIND_CASE} as kind from part")
def _(t: Tables):
    return R.classify(t.part, ["p_name", "p_type"], KIND_RULES, "other", "kind").select("p_partkey", "kind")


@query(
    "rl_01_classify_by_table",
    """with r as (select split_part(p_name, ' ', 1) || case when p_size > 40 then '' else '#' end as word, min(p_partkey) as ord, 'brand of ' || word as label from part group by 1)
       select p_partkey, text, coalesce(arg_min(label, ord), 'none') as label from (select p_partkey, p_type || ' ' || p_name as text from part) left join r on contains(lower(text), word)
       group by all""",
)
def _(t: Tables):
    # a mark at the end makes words that occur nowhere
    word = F.concat(F.split("p_name", " ")[0], F.when(F.col("p_size") > 40, "").otherwise("#"))
    rules = t.part.groupBy(word.alias("word")).agg(F.min("p_partkey").alias("ord"))
    rules = rules.withColumn("label", F.concat(F.lit("brand of "), "word"))
    return R.classify_by_table(t.part.select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("text")), "p_partkey", "text", rules, "none")


# a pattern for every brand and kind, two of which have no literal that all matches hold
PATTERN_SQL = r"""select min(p_partkey) as ord, 'size of ' || p_type || p_size % 5 as label, p_type || '.*\b(' || split_part(p_name, ' ', 1) || '|' || (p_size % 5) || '\d)\b' as pattern from part group by p_type, split_part(p_name, ' ', 1), p_size % 5
        union all select -1, 'double', 'm.ll\s+(gear|GIZMO)' union all select 10000000, 'numbered', '[4-5]\d|\d[0]' """


@query(
    "rl_01_classify_by_patterns",
    f"""with r as ({PATTERN_SQL}), p as (select p_partkey, p_name || ' ' || p_type || ' ' || p_size as text from part)
       select p_partkey, text, coalesce(arg_min(label, ord), 'none') as label from p left join r on regexp_matches(text, pattern, 'i') group by all""",
)
def _(t: Tables):
    kind = F.col("p_size") % 5
    first = F.split("p_name", " ")[0]
    pattern = F.concat("p_type", F.lit(r".*\b("), first, F.lit("|"), kind.cast("string"), F.lit(r"\d)\b"))
    rules = t.part.groupBy(F.concat(F.lit("size of "), "p_type", kind.cast("string")).alias("label"), pattern.alias("pattern")).agg(F.min("p_partkey").alias("ord"))
    more = t.spark.createDataFrame([(-1, "double", r"m.ll\s+(gear|GIZMO)"), (10_000_000, "numbered", r"[4-5]\d|\d[0]")], "ord long, label string, pattern string")
    texts = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string")).alias("text"))
    return R.classify_by_patterns(texts, "p_partkey", "text", rules.select("ord", "label", "pattern").union(more), "none")


TAG_LIST = "list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in KIND_TESTS) + "], lambda x: x is not null)"


@query("rl_02_tag", f"select p_partkey, array_to_string(case when len({TAG_LIST}) > 0 then {TAG_LIST} else ['other'] end, ',') as tags from part")
def _(t: Tables):
    return R.tag(t.part, ["p_name", "p_type"], KIND_RULES, "other").select("p_partkey", F.array_join("tags", ",").alias("tags"))


@query(
    "rl_02_tag_summary",
    f"""select label, count(p_partkey) as n, {rnd('avg(p_retailprice)')} as avg_p_retailprice, {rnd('avg(p_size)')} as avg_p_size from (
        select *, unnest(case when len({TAG_LIST}) > 0 then {TAG_LIST} else ['other'] end) as label from part) group by 1""",
)
def _(t: Tables):
    return R.tag_summary(R.tag(t.part, ["p_name", "p_type"], KIND_RULES, "other"), "tags", "p_partkey", ["p_retailprice", "p_size"])


@query(
    "rl_03_bridge",
    """with cat as (select split_part(p_name, ' ', 2) || case when split_part(p_name, ' ', 2) in ('rod', 'plate') then '#' else '' end as name, min(p_partkey) as ord, 'use of ' || name as note
                    from part group by 1)
       select p_partkey, case when contains(p_name, 'ring') then 'ring' when contains(p_name, 'hot') or contains(p_name, 'red') then 'warm' else coalesce(arg_min(name, ord), 'unsorted') end as ingredient,
         case when contains(p_name, 'ring') then 'holds things' when contains(p_name, 'hot') or contains(p_name, 'red') then 'plain' else coalesce(arg_min(note, ord), 'plain') end as function,
         case when contains(p_name, 'hot') then 'HEAT' when contains(p_name, 'old') then 'AGE' else 'None' end as safety
       from part left join cat on contains(p_name, name) group by p_partkey, p_name""",
)
def _(t: Tables):
    noun = F.split("p_name", " ")[1]
    noun = F.when(noun.isin("rod", "plate"), F.concat(noun, F.lit("#"))).otherwise(noun)
    catalogue = t.part.groupBy(noun.alias("name")).agg(F.min("p_partkey").alias("ord"))
    catalogue = catalogue.withColumn("note", F.concat(F.lit("use of "), "name"))
    out = R.bridge(
        t.part.select("p_partkey", "p_name"), "p_partkey", "p_name", KIND_RULES[:2], catalogue, "name", "ord", "note",
        ("unsorted", "plain"), {"ring": "holds things"}, [R.Rule("HEAT", ("hot",)), R.Rule("AGE", ("old",))],
    )
    return out.drop("p_name")


EXCLUDE = [("heat", "contains(p_name, 'hot')"), ("large", "p_size > 40"), ("promo", "p_type = 'PROMO'"), ("heat again", "contains(p_name, 'hot')")]


def exclusions(t: Tables):
    return R.apply_exclusions(t.part.select("p_partkey", "p_name", "p_size", "p_type"), [(n, F.expr(c)) for n, c in EXCLUDE])


@query("rl_04_exclusions_kept", f"select p_partkey, p_name, p_size, p_type from part where not ({' or '.join(c for _, c in EXCLUDE)})")
def _(t: Tables):
    return exclusions(t)[0]


@query(
    "rl_04_exclusions_audit",
    "select g.ord, g.rule, count(f.fail) as removed from (values "
    + ", ".join(f"({i}, '{n}')" for i, (n, _) in enumerate(EXCLUDE))
    + ") g(ord, rule) left join (select case "
    + " ".join(f"when {c} then {i}" for i, (_, c) in enumerate(EXCLUDE))
    + " end as fail from part) f on f.fail = g.ord group by all",
)
def _(t: Tables):
    return exclusions(t)[1]


@query("rl_05_popularity", f"select p_partkey, {rnd('p_size * p_retailprice', 2)} as popularity from part")
def _(t: Tables):
    return t.part.select("p_partkey", F.bround(R.popularity("p_size", "p_retailprice"), 2).alias("popularity"))


def score_sql(words: list[str]) -> str:
    return " + ".join(f"case when contains(lower(p_name), '{w}') or contains(lower(p_type), '{w}') then 20 else 0 end" for w in words) + " + least(p_size * p_retailprice / 10000.0, 10)"


@query("rl_06_goal_score", f"select p_partkey, {rnd(score_sql(['red', 'widget', 'promo']))} as score from part")
def _(t: Tables):
    score = R.goal_score(["p_name", "p_type"], ["Red", "widget", "promo"], R.popularity("p_size", "p_retailprice"))
    return t.part.select("p_partkey", F.bround(score, 6).alias("score"))


GOALS = {"bright": ["red", "widget"], "useful": ["widget", "gear"], "cheap": ["promo", "red", "bolt"]}


def recommend_sql(k: int = 3) -> str:
    ctes, done = [], []
    for i, (g, words) in enumerate(GOALS.items()):
        skip = " and ".join(f"p_partkey not in (select p_partkey from g{j})" for j in done) or "true"
        ctes.append(
            f"""g{i} as (select {i} as goal_no, '{g}' as goal, p_partkey, {rnd('score')} as score, row_number() over (order by score desc, p_partkey) as r
            from (select p_partkey, {score_sql(words)} as score from part) where {skip} qualify r <= {k})"""
        )
        done.append(i)
    rows = " union all ".join(f"select goal_no, goal, p_partkey, score, cast({i * k} + r - 1 as int) as pick from g{i}" for i in done)
    return f"with {', '.join(ctes)} {rows}"


@query("rl_07_recommend", recommend_sql())
def _(t: Tables):
    rows = t.part.withColumn("popular", R.popularity("p_size", "p_retailprice"))
    return R.recommend(rows, "p_partkey", ["p_name", "p_type"], "popular", GOALS, 3)


@query(
    "rl_08_weighted_rank",
    f"""select p_partkey, popular, weighted from (select p_partkey, {rnd('p_size * p_retailprice', 2)} as popular, {rnd(f"{rnd('p_size * p_retailprice', 2)} * case when p_type in ('PROMO', 'SMALL') then 2.5 else 1 end")} as weighted from part)
        order by weighted desc, p_partkey limit 10""",
)
def _(t: Tables):
    rows = t.part.select("p_partkey", "p_type", F.bround(R.popularity("p_size", "p_retailprice"), 2).alias("popular"))
    return R.weighted_rank(rows, "popular", F.col("p_type").isin("PROMO", "SMALL"), "p_partkey", 10).drop("p_type")


def baskets(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("basket"), F.col("l_partkey").alias("p_partkey"), "l_extendedprice", "l_quantity")
    return lines.join(t.part.select("p_partkey", "p_type"), "p_partkey")


@query(
    "rl_09_basket_totals",
    f"""select l_orderkey as basket, count(*) as items, {rnd('sum(l_extendedprice)', 2)} as price, {rnd('sum(l_quantity)', 2)} as daily_cost
        from lineitem join part on l_partkey = p_partkey group by 1""",
)
def _(t: Tables):
    return R.basket_totals(baskets(t), "basket", "l_extendedprice", "l_quantity")


@query(
    "rl_09_basket_alerts",
    """select l_orderkey as basket, p_type, count(*) as n from lineitem join part on l_partkey = p_partkey where p_type <> 'ECONOMY' group by all having count(*) > 1""",
)
def _(t: Tables):
    return R.basket_alerts(baskets(t), "basket", "p_type", ignore="ECONOMY")


@query(
    "rl_10_daily_cost",
    """select p_partkey, cast(trunc(case when p_type = 'LARGE' then 0 when p_type = 'PROMO' then p_retailprice / p_size when p_type = 'SMALL' then p_retailprice / (p_size * 30)
       when p_type = 'MEDIUM' and p_size >= 10 then p_retailprice / (p_size / 2.0) else p_retailprice / 30.0 end) as int) as cost from part""",
)
def _(t: Tables):
    unit = F.when(F.col("p_type") == "PROMO", F.lit(" days")).when(F.col("p_type") == "SMALL", F.lit(" months supply")).when(F.col("p_type") == "MEDIUM", F.lit(" tablets"))
    text = F.concat_ws(" ", "p_name", F.concat(F.col("p_size").cast("string"), F.coalesce(unit, F.lit(" mg"))))
    price = F.when(F.col("p_type") == "LARGE", F.lit(0.0)).otherwise(F.col("p_retailprice"))
    return t.part.select("p_partkey", R.daily_cost(price, text, "days", "months supply|months", "tablets|pcs").alias("cost"))


@query(
    "rl_11_city_index",
    f"""with c as (select n_name as city, count_if(c_mktsegment = 'BUILDING') as building, count_if(c_mktsegment = 'MACHINERY') as machinery,
          count_if(c_mktsegment = 'HOUSEHOLD') as household, count(*) as total, {rnd('median(c_acctbal)')} as c_acctbal, {rnd('median(c_custkey)')} as c_custkey
          from customer join nation on c_nationkey = n_nationkey group by 1)
        select *, {rnd('(building + machinery) / nullif(household, 0)', 4)} as ratio_index from c""",
)
def _(t: Tables):
    stores = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("n_name", "city")
    flags = {n: F.col("c_mktsegment") == n.upper() for n in ("building", "machinery", "household")}
    return M.city_index(stores, "city", flags, ["building", "machinery"], "household", ["c_acctbal", "c_custkey"])


@query("rl_12_cartogram", f"with {TIER_SQL} select area, cell, cast(tier as int) as tier, n, size, {rnd('n / nullif(size, 0)')} as ratio from tiers")
def _(t: Tables):
    grid, cities = tier_sides(t)
    names = {"region_left": "area", "name_left": "cell", "region_right": "region", "name_right": "city"}
    return M.cartogram(grid, cities, names, ["n"], "size", F.col("cell") == "everywhere")


# ------------------------------------------------------------------ funnels

STEPS = ["view", "click", "signup", "purchase"]


def sessions(t: Tables):
    """One row per user and day with a flag per step."""
    return t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(*[F.bool_or(F.col("event_type") == s).alias(s) for s in STEPS])


def funnel_sql(cumulative: bool) -> str:
    tests = [("visit", "true")]
    for i, s in enumerate(STEPS):
        tests.append((s, " and ".join(STEPS[: i + 1]) if cumulative else s))
    rows = " union all ".join(f"select {i + 1} as step, '{n}' as name, count_if({c}) as n from s" for i, (n, c) in enumerate(tests))
    return f"""with s as (select user_id, cast(ts as date) as day, {", ".join(f"bool_or(event_type = '{s}') as {s}" for s in STEPS)} from events group by all),
      c as ({rows}), w as (select *, lag(n) over (order by step) as p, first(n) over (order by step) as f from c)
      select step, name, n, case when p is null then 100.0 else {rnd('n * 100.0 / p')} end as pct_of_previous, {rnd('n * 100.0 / f')} as pct_of_first,
      coalesce(p - n, 0) as dropped, coalesce({rnd('(p - n) * 100.0 / p')}, 0.0) as dropped_pct from w"""


for _name, _cumulative in {"fn_01_funnel": False, "fn_02_funnel_cumulative": True}.items():

    @query(_name, funnel_sql(_cumulative))
    def _(t: Tables, cumulative=_cumulative):
        return N.funnel(sessions(t), [("visit", F.lit(True)), *[(s, F.col(s)) for s in STEPS]], cumulative)


# ------------------------------------------------------------------ quality


@query(
    "qc_01_reconcile",
    """select (select count(*) from lineitem) as rows_before, count(*) as rows_after, (select count(*) from lineitem) = count(*) as equal
       from (select distinct l_orderkey, l_linenumber from lineitem)""",
)
def _(t: Tables):
    return Q.reconcile(t.lineitem, t.lineitem.select("l_orderkey", "l_linenumber").distinct())


@query("qc_01_tag_totals", f"select kind, count(*) as n from (select {KIND_CASE} as kind from part) where kind <> 'other' group by 1")
def _(t: Tables):
    return Q.tag_totals(R.classify(t.part, ["p_name", "p_type"], KIND_RULES, "other", "kind"), "kind", "other")


# -------------------------------------------------------------------- marts


def event_dimension(t: Tables) -> DataFrame:
    dim = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    # keys moved by twenty leave events of twenty users without a match
    return dim.select((F.col("c_custkey") + 20).alias("user_id"), F.col("r_name").alias("area"), F.col("n_name").alias("place"))


def event_marts(t: Tables, pin: bool = False):
    fact = M.hourly_fact(t.events.select("event_id", "ts", "user_id", "event_type", "value"), "ts")
    return M.build_marts(fact, event_dimension(t), "user_id", "area", "place", "event_type", "value", ["event_id"], pin=pin)


FACT = """dim as (select c_custkey + 20 as user_id, r_name as area, n_name as place from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
  fact as (select event_id, ts, event_type, value, cast(hour(ts) as int) as hour, case when isodow(ts) >= 6 then 'weekend' else 'weekday' end as day_type, user_id,
    coalesce(area, 'unassigned') as area, coalesce(place, 'unassigned') as place from events left join dim using (user_id))"""


def level_sql(keys: str) -> str:
    return f"""with {FACT} select {keys}, coalesce(day_type, 'all') as day_type, count(value) as n, {rnd('avg(value)', 8)} as mean
        from fact group by grouping sets (({keys}, day_type), ({keys}))"""


@query("qc_02_mart_area_hours", level_sql("area, hour"))
def area_hours(t: Tables):
    return event_marts(t)["area_hours"]


@query("qc_02_mart_place_hours", level_sql("area, place, hour"))
def _(t: Tables):
    return event_marts(t)["place_hours"]


@query(
    "qc_02_mart_categories",
    f"""with {FACT}, a as (select area, place, event_type, {rnd('sum(value)', 2)} as total from fact group by all)
        select area, place, event_type, coalesce(total, 0) as total from (select * from (select distinct area from fact), (select distinct place from fact), (select distinct event_type from fact))
        left join a using (area, place, event_type)""",
)
def _(t: Tables):
    return M.dense_categories(event_marts(t)["categories"], "area", "place", "event_type")


@query("qc_02_mart_time_pattern", f"with {FACT} select area, place, hour, count(value) as n, {rnd('avg(value)', 8)} as mean from fact group by all")
def _(t: Tables):
    return event_marts(t)["time_pattern"]


@query(
    "qc_02_mart_sample",
    f"with {FACT} select event_id, event_type, value, hour, day_type, area, place from fact where cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 1000 < 10",
)
def _(t: Tables):
    return event_marts(t)["sample"].select("event_id", "event_type", "value", "hour", "day_type", "area", "place")


@query("qc_02_mart_dimension", f"with {FACT} select * from dim")
def _(t: Tables):
    return event_marts(t)["dimension"]


PUBLISHED = " union all ".join(
    f"select '{name}' as mart, count(*) as n, {measure} as measure from ({body})"
    for name, body, measure in [
        ("area_hours", "select area, coalesce(day_type, 'all') as day_type, count(value) as n from fact group by grouping sets ((area, hour, day_type), (area, hour))", "cast(sum(n) as double)"),
        ("place_hours", "select count(value) as n from fact group by grouping sets ((area, place, hour, day_type), (area, place, hour))", "cast(sum(n) as double)"),
        ("categories", "select round_even(sum(value), 2) as total from fact group by area, place, event_type", rnd("sum(total)", 1)),
        ("time_pattern", "select count(value) as n from fact group by area, place, hour", "cast(sum(n) as double)"),
        ("sample", "select event_id from fact where cast('0x' || substr(md5(cast(event_id as varchar)), 1, 8) as bigint) % 1000 < 10", "cast(sum(event_id) as double)"),
        ("dimension", "select user_id from dim", "cast(sum(user_id) as double)"),
    ]
)
MEASURES = {"area_hours": "n", "place_hours": "n", "categories": "total", "time_pattern": "n", "sample": "event_id", "dimension": "user_id"}


@query("qc_02_published", f"with {FACT} {PUBLISHED}")
def _(t: Tables):
    """All marts written from one reduced table and read back."""
    folder = scratch_path(t.spark, "marts")
    M.publish_marts(event_marts(t, pin=True), folder)
    read = [t.spark.read.parquet(f"{folder}/{m}").agg(F.lit(m).alias("mart"), F.count(F.lit(1)).alias("n"), F.bround(F.sum(c).cast("double"), 1).alias("measure")) for m, c in MEASURES.items()]
    return reduce(DataFrame.unionByName, read)


@query("qc_02_mart_by_days", level_sql("area, place, hour"))
def _(t: Tables):
    """A table of reduced days: all days as they were, then the first half of them brought up to date."""
    path = scratch_path(t.spark, "days")
    fact = M.hourly_fact(t.events.select("event_id", "ts", "user_id", "event_type", "value"), "ts")
    first, last = fact.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    half, names = days[: len(days) // 2], ("user_id", "area", "place", "event_type", "value", "ts", path)
    stale = fact.withColumn("value", F.when(F.to_date("ts") < F.lit(days[len(half)]), F.lit(-1.0)).otherwise(F.col("value")))
    for rows, some in [(stale, days), (fact, half)]:
        M.refresh_days(rows, event_dimension(t), *names, some)
    return M.marts_of(t.spark.read.parquet(path), "area", "place", "event_type")["place_hours"]


# ---------------------------------------------------------------- streaming


LATE = "ts < timestamp_ntz'2024-01-06 00:00:00' and event_id % 20 = 0"
PARTS = [
    f"ts < timestamp_ntz'2024-01-10 00:00:00' and not ({LATE})",
    "ts >= timestamp_ntz'2024-01-10 00:00:00' and ts < timestamp_ntz'2024-01-20 00:00:00'",
    f"ts >= timestamp_ntz'2024-01-20 00:00:00' or ({LATE})",
]


def event_stream(t: Tables):
    """All events, landed in three files, the last with rows that come late; one file a batch."""
    folder = scratch_path(t.spark, "landing")
    for n, part in enumerate(PARTS):
        t.events.where(part).coalesce(1).write.parquet(f"{folder}/{n}")
    return I.landed(t.spark, f"{folder}/*", t.events.schema, files_per_batch=1)


@query("stm_01_dedup", "select distinct user_id, event_type from events")
def _(t: Tables):
    path, checkpoint = scratch_path(t.spark, "stream-dedup"), scratch_path(t.spark, "stream-state")
    rows = event_stream(t).select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    I.drain(I.stream_dedup(rows, ["user_id", "event_type"], "ts", "60 days"), path, checkpoint)
    return t.spark.read.parquet(path).select("user_id", "event_type")


@query(
    "stm_02_upsert",
    """select user_id, event_type, event_id, ts, value from (select *, row_number() over (partition by user_id, event_type
       order by ts desc, event_id desc) as rn from events) where rn = 1""",
)
def _(t: Tables):
    path, checkpoint = scratch_path(t.spark, "stream-upsert"), scratch_path(t.spark, "stream-state")
    keys, version = ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]
    I.stream_upsert(event_stream(t).select(*keys, "event_id", "ts", "value"), keys, version, path, checkpoint)
    I.compact(t.spark, path, keys, version)
    return I.current(t.spark, path, keys, version)


@query(
    "stm_03_daily_counts",
    """select cast(ts as date) as day, event_type, count(*) as n from events
       where not (ts < timestamp '2024-01-06' and event_id % 20 = 0)
         and cast(ts as date) + interval 1 day <= (select max(ts) - interval 1 day from events) group by all""",
)
def _(t: Tables):
    """Days that the watermark has closed; rows that come after it are dropped."""
    path, checkpoint = scratch_path(t.spark, "stream-daily"), scratch_path(t.spark, "stream-state")
    rows = event_stream(t).select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    I.drain(I.stream_daily_counts(rows, "ts", "event_type", "1 day"), path, checkpoint)
    return t.spark.read.parquet(path)
