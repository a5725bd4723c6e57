"""Queries: sources, sinks, projections, joins, set operations."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.functions import columns as C, text as X
from millrace.operators import cleaning, joins, ordering
from millrace.plans.registry import Tables, query, rnd
from millrace.session import scratch_path
from millrace.sources import readers, writers

# ---------------------------------------------------------------- sources

ORDER_CSV = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


@query("src_01_csv_scan", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def _(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    writers.write_csv(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), path)
    return readers.read_csv(t.spark, path, ORDER_CSV)


# a text with its line breaks, quotes and separators, blanks at both ends, '' and null
QUOTED_CSV = "doc_id long, title string, text string, note string"
QUOTED_SQL = """select doc_id, '"' || lang || '", ' || source || ' ""' as title, text || chr(10) || '"' || lang || '"' || chr(13) || chr(10) || ',' as text,
       case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then '  ' || lang || ' ' end as note from documents"""


def _quoted(t: Tables):
    note = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.format_string("  %s ", "lang"))
    text = F.concat("text", F.lit('\n"'), "lang", F.lit('"\r\n,'))
    return t.documents.select("doc_id", F.concat(F.lit('"'), "lang", F.lit('", '), "source", F.lit(' ""')).alias("title"), text.alias("text"), note.alias("note"))


@query("src_01_quoted_csv", QUOTED_SQL)
def _(t: Tables):
    path = scratch_path(t.spark, "quoted-csv")
    writers.write_csv(_quoted(t), path)
    return readers.read_csv(t.spark, path, QUOTED_CSV)


@query("snk_01_quoted_csv", QUOTED_SQL)
def _(t: Tables):
    """One file with a byte-order mark, written and read by several tasks."""
    path = scratch_path(t.spark, "quoted-csv")
    writers.write_csv(_quoted(t), path, mark=True, one_file=True)
    return readers.read_csv(t.spark, path, QUOTED_CSV)


@query(
    "src_02_many_csv",
    """select event_id, user_id, case when event_type = 'purchase' then value end as amount,
       case when event_type = 'purchase' then 'paid' else 'free' end as folder from events""",
)
def _(t: Tables):
    root = scratch_path(t.spark, "events-csv")
    paid = F.col("event_type") == "purchase"
    writers.write_csv(t.events.where(paid).select("event_id", "user_id", F.col("value").alias("amount")), f"{root}/paid")
    writers.write_csv(t.events.where(~paid).select("event_id", "user_id"), f"{root}/free")
    both = readers.read_many(
        t.spark, [(f"{root}/pai*", "event_id long, user_id long, amount double"), (f"{root}/fre*", "event_id long, user_id long")]
    )
    return both.select("event_id", "user_id", "amount", F.regexp_extract("source_file", r"/(paid|free)/[^/]*$", 1).alias("folder"))


@query("src_03_parquet_scan", "select l_orderkey, l_extendedprice from lineitem where l_quantity >= 49")
def _(t: Tables):
    return t.lineitem.where("l_quantity >= 49").select("l_orderkey", "l_extendedprice")


@query("src_04_zipped_csv", "select p_partkey, p_name || chr(10) || p_type as p_name, p_brand, p_retailprice from part")
def _(t: Tables):
    def pack(batches):
        for n, batch in enumerate(batches):
            blob = io.BytesIO()
            with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
                # two members with their columns in other orders and encodings
                half = len(batch) // 2
                archive.writestr("parts.csv", batch[:half].to_csv(index=False).encode("utf-8-sig"))
                archive.writestr("more.csv", batch[half:][batch.columns[::-1]].to_csv(index=False).encode("cp949"))
                archive.writestr("readme.txt", "not a table")
            yield pd.DataFrame({"content": [blob.getvalue()]})

    name = F.concat("p_name", F.lit("\n"), "p_type")
    archives = t.part.select("p_partkey", name.alias("p_name"), "p_brand", "p_retailprice").mapInPandas(pack, "content binary")
    records = readers.unzip_records(archives, "content", ".csv", ["p_partkey", "p_name", "p_brand", "p_retailprice"], ["utf-8-sig", "cp949"])
    return readers.typed(records, "p_partkey long, p_name string, p_brand string, p_retailprice double")


@query("src_05_load_dimension", "select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as s_nationkey from supplier")
def _(t: Tables):
    rows = t.supplier.select(F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"))
    echoed = rows.agg(*[F.lit(c.upper()).alias(c) for c in rows.columns])
    return readers.load_dimension(rows.unionByName(echoed), "s_name", "S_NAME", ["s_suppkey", "s_nationkey"])


@query(
    "src_06_flatten_json",
    """select event_id, user_id as id, event_type as kind, cast(json_extract_string(props, '$.k') as int) as k, 'a' as tag,
              value as score from events
       union all
       select event_id, user_id, event_type, cast(json_extract_string(props, '$.k') as int), 'b', -1.0 from events""",
)
def _(t: Tables):
    score = F.col("value")
    items = F.array(F.struct(F.lit("a").alias("tag"), score.alias("score")), F.struct(F.lit("b").alias("tag"), F.lit(None).cast("double").alias("score")))
    data = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"), F.from_json("props", "k int").alias("props"))
    raw = t.events.select("event_id", F.to_json(F.struct(data.alias("data"), items.alias("items"))).alias("payload"))
    fields = {
        "id": F.col("j.data.id"),
        "kind": F.col("j.data.kind"),
        "k": F.col("j.data.props.k"),
        "tag": F.col("item.tag"),
        "score": F.coalesce("item.score", F.lit(-1.0)),
    }
    schema = "data struct<id:long, kind:string, props:struct<k:int>>, items array<struct<tag:string, score:double>>"
    return readers.flatten_json(raw, "payload", schema, fields, explode="j.items", keep=["event_id"])


@query(
    "src_07_prebuilt_table",
    "select event_type, cast(ts as date) as day, count(*) as n from events group by all",
)
def _(t: Tables):
    path = scratch_path(t.spark, "daily-mart")
    counts = t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    writers.publish(counts, path, ["event_type"])
    return t.spark.read.parquet(path).select("event_type", "day", "n")


FEATURE_SQL = "select cast(c_custkey as varchar) as code, c_name as name, 'Point' as geometry_type from customer"


def feature_files(t: Tables, per_document: int) -> str:
    """Customers as feature collections, one a line."""
    path = scratch_path(t.spark, "features")
    props = F.create_map(F.lit("code"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"))
    point = F.struct(F.lit("Point").alias("type"), F.array(F.lit(10.5), F.lit(20.5)).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), point.alias("geometry"))
    docs = t.customer.groupBy(F.floor(F.col("c_custkey") / per_document).alias("g")).agg(F.collect_list(feature).alias("features"))
    docs.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.text(path)
    return path


def feature_columns(features: DataFrame) -> DataFrame:
    return features.select(F.col("properties")["code"].alias("code"), F.col("properties")["name"].alias("name"), "geometry_type")


@query("src_08_features", FEATURE_SQL)
def _(t: Tables):
    """One document a line: a file is split between tasks."""
    return feature_columns(readers.read_features(t.spark, feature_files(t, 100), multi_line=False))


@query("src_08_large_documents", FEATURE_SQL)
def _(t: Tables):
    """Documents of any size, read feature by feature."""
    return feature_columns(readers.read_features(t.spark, feature_files(t, 1000)))


# ------------------------------------------------------------------ sinks


@query("snk_01_write_csv", "select event_id, user_id, event_type, value from events")
def _(t: Tables):
    path = scratch_path(t.spark, "sink-csv")
    writers.write_csv(t.events.select("event_id", "user_id", "event_type", "value"), path, mark=True)
    return readers.read_csv(t.spark, path, "event_id long, user_id long, event_type string, value double")


@query("snk_02_publish", "select o_orderkey, o_totalprice, o_orderstatus from orders")
def _(t: Tables):
    path = scratch_path(t.spark, "orders-by-status")
    writers.publish(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path)


@query(
    "snk_02_publish_table",
    """select o_orderkey, o_orderstatus, count(l_orderkey) as n_lines, round_even(coalesce(sum(l_extendedprice), 0), 2) as amount
       from orders left join lineitem on l_orderkey = o_orderkey group by all""",
)
def _(t: Tables):
    """Header and detail tables in buckets by their key, joined and grouped without a shuffle."""
    where = scratch_path(t.spark, "bucketed")
    writers.publish_table(t.orders.select("o_orderkey", "o_orderstatus"), "header_rows", bucket_by=["o_orderkey"], buckets=8, path=where)
    writers.publish_table(t.lineitem.select("l_orderkey", "l_extendedprice"), "detail_rows", bucket_by=["l_orderkey"], buckets=8, path=where)
    head, detail = t.spark.table("header_rows"), t.spark.table("detail_rows")
    lines = detail.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.sum("l_extendedprice").alias("amount"))
    both = head.join(lines, head.o_orderkey == lines.l_orderkey, "left")
    return both.select("o_orderkey", "o_orderstatus", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.bround(F.coalesce("amount", F.lit(0.0)), 2).alias("amount"))


SPLIT = "timestamp_ntz'2024-01-16 00:00:00'"


@query(
    "snk_03_upsert",
    """select user_id, event_type, event_id, ts, value from (select *, row_number() over (partition by user_id, event_type
       order by ts desc, event_id desc) as rn from events) where rn = 1""",
)
def _(t: Tables):
    cols = ["user_id", "event_type", "event_id", "ts", "value"]
    old = writers.upsert_latest(t.events.where(f"ts < {SPLIT}").select(*cols), t.events.limit(0).select(*cols), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return writers.upsert_latest(old, t.events.where(f"ts >= {SPLIT}").select(*cols), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@query(
    "snk_04_insert_new",
    """with k as (select user_id, event_type, hour(ts) as h, event_id, ts from events)
       select user_id, event_type, h, event_id from (select *, row_number() over (partition by user_id, event_type, h order by event_id) as rn
         from k where ts >= timestamp '2024-01-16') n
       where rn = 1 and not exists (select 1 from k o where o.ts < timestamp '2024-01-16'
         and o.user_id = n.user_id and o.event_type = n.event_type and o.h = n.h)""",
)
def _(t: Tables):
    rows = t.events.select("user_id", "event_type", F.hour("ts").cast("long").alias("h"), "event_id", "ts")
    old, new = rows.where(f"ts < {SPLIT}"), rows.where(f"ts >= {SPLIT}")
    added = writers.insert_new(old, new, ["user_id", "event_type", "h"], [F.col("event_id")])
    path = scratch_path(t.spark, "inserted")
    writers.publish(old, path)
    n = writers.append_new(t.spark, path, new, ["user_id", "event_type", "h"], [F.col("event_id")])
    table = t.spark.read.parquet(path).where(f"ts >= {SPLIT}").drop("ts")
    # what was appended is what insert_new gives, and the number returned is its size
    return table.join(added.select("event_id"), "event_id", "left_semi").where(F.lit(n) == added.count()).select("user_id", "event_type", "h", "event_id")


@query("snk_05_json_records", "select cast(to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_size': p_size, 'p_retailprice': p_retailprice}) as varchar) as record from part")
def _(t: Tables):
    return writers.to_json_records(t.part.select("p_partkey", "p_name", "p_size", "p_retailprice"))


# ------------------------------------------------------- projections


@query(
    "prj_01_standardize",
    """select 'part' as source, cast(p_partkey as varchar) as product_id, p_name as product_name, p_retailprice as price from part
       union all select 'supplier', cast(s_suppkey as varchar), s_name, s_acctbal from supplier""",
)
def _(t: Tables):
    a = cleaning.standardize(t.part, {"product_id": F.col("p_partkey").cast("string"), "product_name": "p_name", "price": "p_retailprice"}, "part")
    b = cleaning.standardize(t.supplier, {"product_id": F.col("s_suppkey").cast("string"), "product_name": "s_name", "price": "s_acctbal"}, "supplier")
    return cleaning.union_all(a, b)


@query(
    "prj_02_to_number",
    """select o_orderkey, case when o_orderstatus = 'F' then o_totalprice when o_orderstatus = 'O' then o_totalprice * 1e6 end as n from orders""",
)
def _(t: Tables):
    price = F.col("o_totalprice")
    suffixed = F.when(F.col("o_orderkey") % 2 == 0, F.concat(price.cast("string"), F.lit("d"))).otherwise(F.col("o_orderpriority"))
    raw = F.when(F.col("o_orderstatus") == "F", price.cast("string")).when(F.col("o_orderstatus") == "O", (price * 1e6).cast("string")).otherwise(suffixed)
    return t.orders.select("o_orderkey", C.to_number(raw).alias("n"))


@query("prj_03_clean_numeric", "select o_orderkey, case o_orderstatus when 'F' then o_totalprice when 'O' then o_totalprice * 1e6 end as price from orders")
def _(t: Tables):
    shown = F.when(F.col("o_orderstatus") == "P", F.lit(" n/a ")).when(F.col("o_orderstatus") == "F", F.concat(F.lit("$ "), F.format_number("o_totalprice", 2)))
    shown = shown.otherwise((F.col("o_totalprice") * 1e6).cast("string"))
    return t.orders.select("o_orderkey", C.clean_numeric(shown).alias("price"))


@query(
    "prj_04_fill",
    "select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'unknown') as status, coalesce(case when o_orderpriority <> '5-LOW' then o_totalprice end, 0) as price from orders",
)
def _(t: Tables):
    holes = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"))
    return cleaning.fill(holes, {"status": "unknown", "price": 0.0})


@query("prj_05_safe_ratio", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('l_quantity / nullif(l_tax, 0)', 4)} as ratio from lineitem")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", C.safe_ratio("l_quantity", "l_tax", 4).alias("ratio"))


@query(
    "prj_06_filter_in",
    """select o_orderkey from (select o_orderkey, o_orderstatus, nullif(o_orderpriority, '3-MEDIUM') as p from orders)
       where o_orderstatus in ('F', 'O') and coalesce(p not in ('5-LOW', '1-URGENT'), true)""",
)
def _(t: Tables):
    rows = t.orders.withColumn("p", F.nullif("o_orderpriority", F.lit("3-MEDIUM")))
    return cleaning.filter_in(rows, {"o_orderstatus": ["F", "O"]}, {"p": ["5-LOW", "1-URGENT"]}).select("o_orderkey")


@query("prj_07_slice_by", "select l_orderkey, l_quantity from lineitem where l_returnflag = 'R' and l_linestatus = 'F'")
def _(t: Tables):
    return cleaning.slice_by(t.lineitem, l_returnflag="R", l_linestatus="F").select("l_orderkey", "l_quantity")


@query("prj_08_drop_missing", "select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderstatus <> 'P' and o_totalprice >= 1000 and o_orderstatus <> 'O'")
def _(t: Tables):
    holes = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.when(F.col("o_totalprice") >= 1000, F.col("o_totalprice")).alias("o_totalprice"))
    return cleaning.drop_missing(holes, ["o_orderstatus", "o_totalprice"], "o_orderstatus", "O")


@query(
    "prj_09_search",
    """select p_partkey, p_name from part where contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'red')
       and contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'wid')""",
)
def _(t: Tables):
    return cleaning.search(t.part, ["p_name", "p_brand", "p_type"], "WID  red").select("p_partkey", "p_name")


@query("prj_10_recode", "select o_orderkey, case o_orderstatus when 'F' then 'filled' when 'O' then 'open' else 'other' end as status from orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", C.recode("o_orderstatus", {"F": "filled", "O": "open"}, "other").alias("status"))


@query(
    "prj_11_bucketize",
    """select event_id, case when value < 10 then 'low' when value < 50 then 'mid' when value < 100 then 'high' else 'top' end as band from events""",
)
def _(t: Tables):
    return t.events.select("event_id", C.bucketize("value", [10, 50, 100], ["low", "mid", "high", "top"]).alias("band"))


@query("prj_12_compose_key", "select p_partkey, trim(coalesce(nullif(p_type, 'PROMO'), '') || ' ' || p_name || ' ' || p_brand) as k from part")
def _(t: Tables):
    return t.part.select("p_partkey", C.compose_key([F.nullif("p_type", F.lit("PROMO")), "p_name", "p_brand"]).alias("k"))


@query("prj_13_split_label", "select p_partkey, split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b, split_part(p_name, ' ', 3) as c from part")
def _(t: Tables):
    return t.part.select("p_partkey", *[c.alias(n) for c, n in zip(C.split_label("p_name", 3), "abc")])


@query("prj_14_clamp", "select event_id, least(greatest(value, 5.0), 100.0) as v from events")
def _(t: Tables):
    return t.events.select("event_id", C.clamp("value", 5.0, 100.0).alias("v"))


@query(
    "prj_15_pyramid",
    f"""select lang, quality, case when quality = 0 then -n else n end as n from
        (select lang, quality, count(*) as n from documents join labels using (doc_id) group by all)""",
)
def _(t: Tables):
    counts = t.documents.join(t.labels, "doc_id").groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("lang", "quality", C.pyramid("quality", 0, "n").alias("n"))


@query(
    "prj_16_with_order",
    """select o_orderkey, case o_orderpriority when '5-LOW' then 0 when '3-MEDIUM' then 1 when '1-URGENT' then 2 else 3 end as ord from orders""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", C.ordinal("o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"]).alias("ord"))


@query(
    "prj_17_melt_split",
    """select l_orderkey, 'amount' as kind, 'quantity' as part, l_quantity as value from lineitem
       union all select l_orderkey, 'amount', 'price', l_extendedprice from lineitem
       union all select l_orderkey, 'rate', 'discount', l_discount + 0.0 from lineitem
       union all select l_orderkey, 'rate', 'tax', l_tax + 0.0 from lineitem""",
)
def _(t: Tables):
    wide = t.lineitem.select(
        "l_orderkey",
        F.col("l_quantity").alias("amount_quantity"),
        F.col("l_extendedprice").alias("amount_price"),
        (F.col("l_discount") + 0.0).alias("rate_discount"),
        (F.col("l_tax") + 0.0).alias("rate_tax"),
    )
    return cleaning.melt_split(wide, ["l_orderkey"], wide.columns[1:], r"^([^_]+)_(.+)$", ["kind", "part"])


@query(
    "prj_18_clean_url",
    """select page_id, case when contains(url, '.example.net') or not starts_with(url, 'https') then 'https://placeholder.invalid/none.png' else url end as url from pages""",
)
def _(t: Tables):
    raw = F.when(F.startswith("url", F.lit("https")), F.concat(F.lit(" "), "url")).otherwise(F.lit("NaN"))
    return t.pages.select("page_id", X.clean_url(raw, "https://placeholder.invalid/none.png", F.contains("url", F.lit(".example.net")), ["nan", "none"]).alias("url"))


@query(
    "prj_19_build_url",
    """select p_partkey, case when contains(lower(p_type), 'promo') then 'https://promo.example.com/s?q='
         when contains(lower(p_type), 'small') then 'https://small.example.com/find?kw=' else 'https://all.example.com/search?query=' end
         || replace(url_encode(p_name || ' ' || p_brand), '%20', '+') as url from part""",
)
def _(t: Tables):
    templates = {"promo": "https://promo.example.com/s?q=", "small": "https://small.example.com/find?kw="}
    url = X.build_url("p_type", F.concat_ws(" ", "p_name", "p_brand"), templates, "https://all.example.com/search?query=")
    return t.part.select("p_partkey", url.alias("url"))


# -------------------------------------------------------------------- joins


@query(
    "jn_01_enrich",
    """select c_custkey, coalesce(n_name, 'unassigned') as n_name, coalesce(n_regionkey, -1) as n_regionkey
       from customer left join nation on c_nationkey = n_nationkey + 5""",
)
def _(t: Tables):
    # keys moved by five leave customers of five nations without a match
    dim = t.nation.select((F.col("n_nationkey") + 5).alias("c_nationkey"), "n_name", "n_regionkey")
    out = joins.enrich(t.customer.select("c_custkey", "c_nationkey"), dim, ["c_nationkey"], {"n_name": "unassigned", "n_regionkey": -1})
    return out.select("c_custkey", "n_name", "n_regionkey")


@query(
    "jn_02_lookup",
    """select p_partkey, p_name, (select arg_max(q.p_brand, q.p_partkey) from part q where q.p_name = p.p_name) as last_brand from part p""",
)
def _(t: Tables):
    return joins.lookup(t.part.select("p_partkey", "p_name"), "p_name", t.part, "p_brand", [F.col("p_partkey")], "last", "last_brand")


@query(
    "jn_02_lookup_first",
    """select p_partkey, p_name, (select arg_min(q.p_brand, q.p_partkey) from part q where q.p_name = p.p_name and q.p_brand <> 'Brand#1') as first_brand from part p""",
)
def _(t: Tables):
    table = t.part.withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#1")))
    return joins.lookup(t.part.select("p_partkey", "p_name"), "p_name", table, "p_brand", [F.col("p_partkey")], "first", "first_brand")


@query(
    "jn_03_header_detail",
    "select o_orderkey, o_custkey, l_linenumber, l_partkey, l_extendedprice from orders join lineitem on o_orderkey = l_orderkey",
)
def _(t: Tables):
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("jn_04_keep_keys", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def _(t: Tables):
    keys = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_keys(t.customer.select("c_custkey", "c_name"), keys, ["c_custkey"])


@query("jn_04_drop_keys", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def _(t: Tables):
    keys = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.drop_keys(t.customer.select("c_custkey", "c_name"), keys, ["c_custkey"])


def tier_sides(t: Tables):
    """Cells named by part or by word, and a table of cities to match them with."""
    cities = t.part.groupBy(F.col("p_type").alias("region"), F.col("p_name").alias("city")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")
    )
    word = F.explode(F.array("p_name", F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit("everywhere"), F.concat("p_name", F.lit("s"))))
    grid = t.part.select(F.concat(F.substring("p_type", 1, 2), F.lit("-area")).alias("area"), word.alias("cell")).distinct()
    return grid, cities


TIER_SQL = """
  cities as (select p_type as region, p_name as city, count(*) as n, sum(p_size) as size from part group by all),
  grid as (select distinct substr(p_type, 1, 2) || '-area' as area, unnest([p_name, split_part(p_name, ' ', 2), 'everywhere', p_name || 's']) as cell from part),
  pairs as (select area, cell, n, size, case when city = cell then 1 when contains(city, cell) then 2 when cell = 'everywhere' then 3 end as tier
            from grid left join cities on substr(area, 1, 2) = substr(region, 1, 2)),
  best as (select *, min(tier) over (partition by area, cell) as b from pairs),
  tiers as (select area, cell, b as tier, cast(coalesce(sum(n) filter (where tier = b), 0) as bigint) as n,
            cast(coalesce(sum(size) filter (where tier = b), 0) as bigint) as size from best group by area, cell, b)"""


@query("jn_05_tiered_join", f"with {TIER_SQL} select area, cell, cast(tier as int) as tier, n, size from tiers")
def _(t: Tables):
    grid, cities = tier_sides(t)
    return joins.tiered_join(grid, cities, "area", "cell", "region", "city", ["n", "size"], F.col("cell") == "everywhere")


@query(
    "jn_06_contains_join",
    """with cat as (select split_part(p_name, ' ', 2) as name, min(p_partkey) as ord from part group by 1
                    union all select split_part(p_name, ' ', 1) || ' r', max(p_partkey) + 1 from part group by 1)
       select p_partkey, text, arg_min(name, ord) as found from
         (select p_partkey, upper(p_name) || ' ' || p_type as text from part) p left join cat on contains(lower(text), lower(name)) and length(name) > 1
       group by all""",
)
def _(t: Tables):
    words = F.split("p_name", " ")
    nouns = t.part.groupBy(words[1].alias("name")).agg(F.min("p_partkey").alias("ord"))
    pieces = t.part.groupBy(F.concat(words[0], F.lit(" r")).alias("name")).agg((F.max("p_partkey") + 1).alias("ord"))
    catalogue = nouns.unionByName(pieces).withColumn("found", F.col("name"))
    texts = t.part.select("p_partkey", F.concat_ws(" ", F.upper("p_name"), "p_type").alias("text"))
    return joins.contains_join(texts, "p_partkey", "text", catalogue, "name", "ord", ["found"])


METRIC_SQL = "(select c_nationkey, round_even(avg(c_acctbal), 6) as bal from customer group by 1)"


def _metric(t: Tables):
    return t.customer.groupBy("c_nationkey").agg(F.bround(F.avg("c_acctbal"), 6).alias("bal"))


def _features(t: Tables):
    # shifted, so that some features have no metric
    return t.supplier.select("s_suppkey", (F.col("s_nationkey") + 10).alias("c_nationkey"))


for _mode, _expr in {"null": "bal", "zero": "coalesce(bal, 0)", "mean": f"{rnd(f'coalesce(bal, (select avg(bal) from {METRIC_SQL}))')}"}.items():

    @query(
        f"jn_07_attach_metric_{_mode}",
        f"select s_suppkey, s_nationkey + 10 as c_nationkey, {_expr} as bal from supplier left join {METRIC_SQL} on s_nationkey + 10 = c_nationkey",
    )
    def _(t: Tables, mode=_mode):
        return joins.attach_metric(_features(t), _metric(t), "c_nationkey", "bal", mode).withColumn("bal", F.bround("bal", 6))


@query(
    "jn_08_densify",
    f"""with a as (select p_brand, p_name, p_size, sum(p_retailprice) as s, avg(p_retailprice) as m from part group by all),
        k as (select * from (select distinct p_brand from part), (select distinct p_name from part), (select unnest(range(1, 61)) as p_size))
        select p_brand, p_name, p_size, {rnd('coalesce(s, 0)', 2)} as s, {rnd('m')} as m from k left join a using (p_brand, p_name, p_size)""",
)
def _(t: Tables):
    agg = t.part.groupBy("p_brand", "p_name", "p_size").agg(F.bround(F.sum("p_retailprice"), 2).alias("s"), F.bround(F.avg("p_retailprice"), 6).alias("m"))
    return joins.densify(agg, ["p_brand", "p_name", "p_size"], {"s": 0.0}, {"p_size": list(range(1, 61))})


# ---------------------------------------------------------- set operations


@query(
    "set_01_union_all",
    """select c_custkey as id, c_acctbal as balance, c_mktsegment as segment from customer
       union all select s_suppkey, s_acctbal, null from supplier""",
)
def _(t: Tables):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return cleaning.union_all(a, b)


@query("set_02_distinct_ordered", "select p_name, min(p_partkey) as first_seen from part group by p_name")
def _(t: Tables):
    return ordering.distinct_ordered(t.part, "p_name", "p_partkey")
