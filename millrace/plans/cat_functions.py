"""Queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as C, dates as D, payload as P, text as X
from millrace.plans.registry import Tables, query, rnd

WORDS = r"'[\p{L}\p{N}_]+'"


@query(
    "fn_str_f1_rx_contains",
    "select p_partkey, coalesce(regexp_matches(nullif(p_name, 'red widget'), '(?i)RE?D|wid?get'), false) as hit from part",
)
def _(t: Tables):
    return t.part.select("p_partkey", X.rx_contains(F.nullif("p_name", F.lit("red widget")), "RE?D|wid?get").alias("hit"))


@query("fn_str_f2_any_of", "select doc_id, contains(text, 'the') or contains(text, 'que') or contains(text, 'sch') as hit from documents")
def _(t: Tables):
    return t.documents.select("doc_id", X.any_of("text", ["the", "que", "sch"]).alias("hit"))


@query(
    "fn_str_f3_kw_count",
    """select doc_id, cast((length(lower(text)) - length(replace(lower(text), 'the', ''))) / 3
       + (length(lower(text)) - length(replace(lower(text), 'ion', ''))) / 3 as int) as n from documents""",
)
def _(t: Tables):
    return t.documents.select("doc_id", X.kw_count("text", ["The", "ion"]).alias("n"))


@query(
    "fn_str_f4_leading_brand",
    """select p_partkey, case when p_type = 'PROMO' then split_part(p_name, ' ', 1) when p_type = 'SMALL' then split_part(p_name, ' ', 1)
       when p_type = 'LARGE' then split_part(p_name, ' ', 1) else p_brand end as brand from part""",
)
def _(t: Tables):
    mark = F.when(F.col("p_type") == "PROMO", F.lit("[sale] ")).when(F.col("p_type") == "SMALL", F.lit("[x]"))
    mark = mark.when(F.col("p_type") == "LARGE", F.lit("")).otherwise(F.concat(F.lit("["), "p_brand", F.lit(" ] ")))
    return t.part.select("p_partkey", X.leading_brand(F.concat(mark, "p_name"), ["sale", "new"]).alias("brand"))


@query(
    "fn_str_f5_num_unit",
    """select p_partkey, case when p_type <> 'PROMO' then p_size end as number,
       case when p_type = 'PROMO' then null when p_size > 25 then 'days' else 'pcs' end as unit from part""",
)
def _(t: Tables):
    unit = F.when(F.col("p_size") > 25, F.lit(" days")).otherwise(F.lit("pcs"))
    text = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", F.concat(F.col("p_size").cast("string"), unit)))
    number, found = X.num_unit(text, r"(\d+)\s*(days|pcs)")
    return t.part.select("p_partkey", number.alias("number"), found.alias("unit"))


@query(
    "fn_str_f6_strip_html",
    r"""select page_id, regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[^\p{L}\p{N}_\s]', ' ', 'g') as text from pages""",
)
def _(t: Tables):
    return t.pages.select("page_id", X.strip_non_word(X.strip_html("html")).alias("text"))


@query(
    "fn_str_f7_domain",
    """select page_id, case when starts_with(url, 'https') then replace(regexp_extract(url, 'https?://([^/]+)', 1), 'www.', '') else 'other' end as domain from pages""",
)
def _(t: Tables):
    return t.pages.select("page_id", X.domain(F.when(F.startswith("url", F.lit("https")), F.col("url")), "other").alias("domain"))


@query("fn_str_f8_tokens", f"select doc_id, len(regexp_extract_all(lower(text), {WORDS})) as n, regexp_extract_all(lower(text), {WORDS})[1] as first from documents")
def _(t: Tables):
    words = X.tokens("text")
    return t.documents.select("doc_id", F.size(words).cast("long").alias("n"), F.try_element_at(words, F.lit(1)).alias("first"))


@query(
    "fn_str_f9_builtins",
    """select p_partkey, lower(p_type) as lowered, trim('  ' || p_name || ' ') as trimmed, starts_with(p_name, 'red') as starts,
       split_part(p_brand, '#', -1) as last_part, substr(p_name, 1, 2) as head, trim(p_type, 'SE') as stripped from part""",
)
def _(t: Tables):
    return t.part.select(
        "p_partkey",
        F.lower("p_type").alias("lowered"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.startswith("p_name", F.lit("red")).alias("starts"),
        F.element_at(F.split("p_brand", "#"), -1).alias("last_part"),
        F.substring("p_name", 1, 2).alias("head"),
        F.trim("p_type", F.lit("SE")).alias("stripped"),
    )


@query(
    "fn_str_f10_lat_lon",
    """select c_custkey, case when c_mktsegment not in ('BUILDING', 'MACHINERY') then c_acctbal end as lat,
       case when c_mktsegment not in ('BUILDING', 'MACHINERY') then cast(c_nationkey as double) end as lon from customer""",
)
def _(t: Tables):
    good = F.concat_ws(", ", F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string"))
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("10.5")).when(F.col("c_mktsegment") == "MACHINERY", F.lit("north,south")).otherwise(good)
    lat, lon = C.lat_lon(text)
    return t.customer.select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query("fn_dt_f1_ymd", "select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as d from orders")
def _(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("20241341")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return t.orders.select("o_orderkey", D.ymd(text).alias("d"))


@query(
    "fn_dt_f2_rfc822",
    """select event_id, case when event_type <> 'error' then cast(epoch(date_trunc('second', ts)) as bigint) - 9 * 3600 end as epoch_s from events""",
)
def _(t: Tables):
    shown = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))
    text = F.when(F.col("event_type") == "error", F.lit("yesterday")).otherwise(shown)
    return t.events.select("event_id", F.unix_seconds(D.rfc822(text)).alias("epoch_s"))


@query("fn_dt_f3_weekday", "select event_id, dayname(ts) as day_name, isodow(ts) >= 6 as weekend from events")
def _(t: Tables):
    return t.events.select("event_id", D.weekday_name("ts").alias("day_name"), D.is_weekend("ts").alias("weekend"))


@query("fn_dt_f4_year_of", "select o_orderkey, case when o_orderstatus <> 'P' then cast(year(o_orderdate) as int) end as y from orders")
def _(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n.d.")).otherwise(F.col("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", D.year_of(text).alias("y"))


@query(
    "fn_ma_f1_builtins",
    f"""select c_custkey, {rnd('ln(1 + abs(c_acctbal))')} as log1p, {rnd('c_acctbal', 1)} as rounded, abs(c_acctbal) as magnitude, cast(trunc(c_acctbal) as int) as whole from customer""",
)
def _(t: Tables):
    b = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.bround(F.log1p(F.abs(b)), 6).alias("log1p"), F.bround(b, 1).alias("rounded"), F.abs(b).alias("magnitude"), b.cast("int").alias("whole")
    )


@query("fn_ma_f2_rescale5", f"select event_id, case when value > 5 then {rnd('value / 20', 1)} else value end as rating from events")
def _(t: Tables):
    return t.events.select("event_id", C.rescale5("value").alias("rating"))


@query(
    "fn_ar_f1_labels",
    """select p_partkey, unnest(case when not contains(p_name, 'red') and p_size <= 25 then ['none'] else
       list_filter([case when contains(p_name, 'red') then 'red' end, case when p_size > 25 then 'big' end], lambda x: x is not null) end) as label from part""",
)
def _(t: Tables):
    labels = F.array(F.when(F.contains("p_name", F.lit("red")), F.lit("red")), F.when(F.col("p_size") > 25, F.lit("big")))
    return t.part.select("p_partkey", F.explode(C.labels_or_default(labels, "none")).alias("label"))


@query(
    "fn_js_f1_json_path",
    """select event_id, json_extract_string(props, '$.k') as k, 'none' as missing, cast(to_json({'k': cast(json_extract_string(props, '$.k') as int)}) as varchar) as back from events""",
)
def _(t: Tables):
    return t.events.select(
        "event_id",
        P.json_path("props", "$.k").alias("k"),
        P.json_path("props", "$.absent", "none").alias("missing"),
        F.to_json(F.from_json("props", "k int")).alias("back"),
    )


@query("fn_js_f2_balanced_json", """select event_id, props as obj, cast(json_extract_string(props, '$.k') as int) as k from events""")
def _(t: Tables):
    script = F.concat(F.lit('window.state = '), "props", F.lit('; track({"t": "}"});'))
    found = t.events.select("event_id", P.balanced_json(script).alias("obj"))
    return found.select("event_id", "obj", F.from_json("obj", "k int")["k"].alias("k"))


@query(
    "fn_js_f2_nested_json",
    """select page_id, cast(to_json({'url': url, 'n': {'size': length(html)}}) as varchar) as obj from pages""",
)
def _(t: Tables):
    body = F.to_json(F.struct("url", F.struct(F.length("html").cast("long").alias("size")).alias("n")))
    script = F.concat(F.lit("<script>var d="), body, F.lit(";</script>"), "html")
    return t.pages.select("page_id", P.balanced_json(script).alias("obj"))
