"""Operators against brute force on small fixtures, with ties, nulls and hot keys."""

import random
import re

import pytest
from pyspark.sql import Window, functions as F

from millrace.functions import columns as C
from millrace.operators import aggregates as A, cleaning, crosstabs as X, funnel as N, joins as J, ordering as O, pages as P, rules as R, tfidf as K
from millrace.operators.running import running_total
from millrace.plans.registry import Tables
from millrace.sources import readers, writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contains_join_equals_every_pair(spark):
    rng = random.Random(3)
    letters = "abcçé"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    names = [(word(rng.randint(1, 5)).upper(), i) for i in range(40)] + [("AB", 99), ("ab", 98)]
    texts = [(i, word(rng.randint(0, 25))) for i in range(150)] + [(900 + i, "xxabxx") for i in range(60)] + [(1000, None), (1001, "")]
    cat = spark.createDataFrame(names, "name string, ord int").withColumn("p", F.col("name"))
    df = spark.createDataFrame(texts, "id int, t string")
    got = {r["id"]: r["p"] for r in J.contains_join(df, "id", "t", cat, "name", "ord", ["p"]).collect()}
    want = {}
    for i, t in texts:
        hits = [(o, n) for n, o in names if len(n) > 1 and t and n.lower() in t.lower()]
        want[i] = min(hits)[1] if hits else None
    assert got == want


def test_contains_join_has_no_nested_loop(spark, folder):
    t = Tables(spark, folder)
    cat = t.part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("b"))
    p = plan(J.contains_join(t.documents, "doc_id", "text", cat, "name", "ord", ["b"]))
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_tiers(spark):
    cities = spark.createDataFrame([("Northland", "Mill", 5), ("Northland", "Millbrook", 7), ("Eastshire", "", 2), ("Westham", "Mill", 1), ("Eastshire", None, 4)], "s string, c string, n int")
    grid = spark.createDataFrame([("North", "Mill"), ("North", "brook"), ("East", "East-all"), ("North", "Ford"), ("West", "")], "a string, d string")
    special = F.startswith("a", F.lit("East"))
    got = {(r["a"], r["d"]): (r["tier"], r["n"]) for r in J.tiered_join(grid, cities, "a", "d", "s", "c", ["n"], special, prefix=3).collect()}
    assert got == {("North", "Mill"): (1, 5), ("North", "brook"): (2, 7), ("East", "East-all"): (3, 6), ("North", "Ford"): (None, 0), ("West", ""): (2, 1)}


def test_densify(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, l string, n int")
    got = sorted(tuple(r) for r in J.densify(df, ["k", "l"], {"n": 0}).collect())
    assert got == [("a", "x", 1), ("a", "y", 0), ("b", "x", 0), ("b", "y", 2)]
    three = J.densify(df.withColumn("m", F.col("n") * 10), ["k", "l", "m"], {}, {"m": [10, 20, 30]}).collect()
    assert len(three) == 12 and len(set(three)) == 12
    assert J.densify(df.limit(0), ["k", "l"], {}).collect() == []


def test_running_total_by_ranges_equals_window(spark):
    rows = [(i % 5, i, float(i % 11)) for i in range(3000)] + [(0, 10_000 + i, 1.0) for i in range(1500)]
    df = spark.createDataFrame(rows, "g int, i int, v double").repartition(6)
    order = [F.desc("g"), F.asc("i")]
    whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = df.withColumn("running", F.sum("v").over(whole)).orderBy("i").collect()
    assert a == running_total(df, order, "v", pieces=7).orderBy("i").collect()
    gaps = df.withColumn("v", F.when(F.col("i") % 900 > 500, F.col("v")))
    a = gaps.withColumn("running", F.sum("v").over(whole)).orderBy("i").collect()
    assert a == running_total(gaps, order, "v", pieces=40).orderBy("i").collect()


def test_sample_n_equals_a_sort(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    for n in (0, 1, 700, 5000, 9000):
        want = df.orderBy(F.md5(F.col("k").cast("string")), "k").limit(n).collect()
        assert sorted(O.sample_n(df, ["k"], n).collect()) == sorted(want)


def test_containment_in_long_texts(spark):
    names = spark.createDataFrame([(1, "Needle in hay"), (2, "ZZ"), (3, "x"), (4, "needle"), (5, "a long name of more than sixteen letters"), (6, None), (7, "\U0001f600\U0001f600")], "o int, n string")
    texts = [(1, "hay " * 20_000 + "NEEDLE IN HAY"), (2, None), (3, ""), (4, "zz top"), (5, "had A Long Name of more than sixteen letters!"), (6, "needl"), (7, "é\U0001f600\U0001f600")]
    got = {r["k"]: r["o"] for r in J.contains_join(spark.createDataFrame(texts, "k int, t string"), "k", "t", names, "n", "o", ["o"]).collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 2, 5: 5, 6: None, 7: 7}


def test_deduplication_is_cut_before_the_shuffle(spark, folder):
    t = Tables(spark, folder)
    for df in (
        O.drop_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], [F.asc("l_partkey")]),
        O.top_n_per_group(t.events, ["user_id"], [F.desc("value")], 3),
        O.flag_top(t.events, "event_type", "value", "event_id"),
    ):
        p = plan(df)
        assert "row_number(), 1, Partial" in p or "row_number(), 3, Partial" in p


def test_flag_top_ignores_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("b", 4, None), (None, 5, 1.0)], "g string, i int, v double")
    assert {r["i"]: r["is_top"] for r in O.flag_top(df, "g", "v", "i").collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_dedup_groups_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, i int")
    assert sorted(r["i"] for r in O.drop_duplicates(df, ["k"], [F.asc("i")]).collect()) == [1, 3]


def test_pareto_and_shares(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)] + [(None,)], "k string")
    got = [(r["k"], r["n"], r["cum_pct"]) for r in O.pareto(df, "k", 90).orderBy("cum_pct").collect()]
    assert got == [("a", 6, 60.0), ("b", 3, 90.0)]
    assert [r["pct"] for r in A.value_counts(df, "k", share=True).collect()] == [60.0, 30.0, 10.0]


def test_group_helpers(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", None, 0), ("b", 3, 1), (None, 1, 1)], "k string, v int, o int")
    assert {r["k"]: r["mode"] for r in A.group_mode(df, ["k"], "v").collect()} == {"a": 1, "b": 3}
    assert {r["k"]: r["first"] for r in A.group_first(df, "k", "v", F.col("o")).collect()} == {"a": 2, "b": 3}
    assert {r["k"]: r["mean"] for r in A.group_mean(df, ["k"], "v").collect()} == {"a": 1.5, "b": 3.0}
    kept = A.with_keys(df, ["k"])
    assert kept.count() == 4


def test_crosstab_totals_add_up(spark, folder):
    rows = Tables(spark, folder).lineitem.select(F.col("l_suppkey").cast("string").alias("s"), "l_returnflag")
    tab = X.crosstab(rows, "s", "l_returnflag", ["R", "A", "N"], margins=True).collect()
    total = [r for r in tab if r["s"] == "total"][0]
    assert total["total"] == rows.count() == sum(r["total"] for r in tab if r["s"] != "total")
    pct = X.crosstab_pct(rows, "s", "l_returnflag", ["R", "A", "N"]).collect()
    assert all(abs(r["R"] + r["A"] + r["N"] - 100) < 1e-4 for r in pct)


def test_melt_rows(spark, folder):
    wide = Tables(spark, folder).lineitem.select("l_orderkey", F.col("l_tax").alias("m_0"), F.col("l_discount").alias("f_1"))
    long = cleaning.melt_split(wide, ["l_orderkey"], ["m_0", "f_1"], r"^([mf])_(\d)$", ["sex", "band"])
    assert long.count() == 2 * wide.count()
    assert {(r["sex"], r["band"]) for r in long.select("sex", "band").distinct().collect()} == {("m", "0"), ("f", "1")}


def test_tfidf_rows_have_length_one_and_one_shuffle_of_tokens(spark, folder):
    docs = Tables(spark, folder).documents
    w = K.tfidf(docs, "doc_id", "text", min_df=2)
    lengths = [r[1] for r in w.groupBy("doc").agg(F.sqrt(F.sum(F.col("weight") ** 2))).collect()]
    assert lengths and all(abs(x - 1) < 1e-9 for x in lengths)
    # counts meet by document and term once; the vocabulary is counted from the texts, by term alone
    shuffles = plan(K.tfidf(docs, "doc_id", "text", min_df=2))
    assert len(re.findall(r"Exchange hashpartitioning\(doc#\d+L, term", shuffles)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(term", shuffles)) == 1


def test_tfidf_by_hand(spark):
    import math

    docs = spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, ""), (4, None)], "id int, t string")
    got = {(r["doc"], r["term"]): r["weight"] for r in K.tfidf(docs, "id", "t").collect()}
    idf = {t: math.log(5 / (1 + d)) + 1 for t, d in [("a", 1), ("b", 2), ("c", 1)]}
    n1, n2 = math.hypot(2 * idf["a"], idf["b"]), math.hypot(idf["b"], idf["c"])
    want = {(1, "a"): 2 * idf["a"] / n1, (1, "b"): idf["b"] / n1, (2, "b"): idf["b"] / n2, (2, "c"): idf["c"] / n2}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_rules(spark):
    rules = [R.Rule("soft", ("Cotton",)), R.Rule("paper", ("sheet",), r"\d+\s*장")]
    df = spark.createDataFrame([(1, "COTTON sheet"), (2, "종이 60장"), (3, None), (4, "장")], "id int, t string")
    assert {r["id"]: r["label"] for r in R.classify(df, ["t"], rules, "?").collect()} == {1: "soft", 2: "paper", 3: "?", 4: "?"}
    assert {r["id"]: r["tags"] for r in R.tag(df, ["t"], rules, "?").collect()} == {1: ["soft", "paper"], 2: ["paper"], 3: ["?"], 4: ["?"]}


def test_exclusions_add_up(spark, folder):
    part = Tables(spark, folder).part
    kept, audit = R.apply_exclusions(part, [("a", F.col("p_size") > 25), ("b", F.col("p_size") > 10), ("null", F.lit(None).cast("boolean"))])
    assert kept.count() + sum(r["removed"] for r in audit.collect()) == part.count()


def test_recommend_equals_greedy_loop(spark):
    rng = random.Random(5)
    items = [(i, rng.choice(["red", "blue", "red blue", "green"]), float(rng.randint(0, 3) * 10000)) for i in range(60)]
    goals = {"g1": ["red"], "g2": ["blue", "red"], "g3": ["green"], "g4": ["red"]}
    df = spark.createDataFrame(items, "id int, t string, pop double")
    got = [(r["goal"], r["id"]) for r in R.recommend(df, "id", ["t"], "pop", goals, 4).orderBy("pick").collect()]
    used, want = set(), []
    for g, words in goals.items():
        score = {i: sum(20 * (w in t) for w in words) + min(p / 10000, 10) for i, t, p in items}
        best = sorted((i for i in score if i not in used), key=lambda i: (-score[i], i))[:4]
        want += [(g, i) for i in best]
        used |= set(best)
    assert got == want


def test_daily_cost(spark):
    rows = [("tea 30 days", 3000.0), ("tea 2months", 6000.0), ("tea 60 bags", 3000.0), ("tea 5 bags", 3000.0), ("tea", 100.0), ("x 0 days 20 bags", 100.0), ("x", 0.0), ("x", None)]
    df = spark.createDataFrame(rows, "t string, p double")
    got = [r[0] for r in df.select(R.daily_cost("p", "t", "days", "months pack|months", "bags|tins")).collect()]
    assert got == [100, 100, 100, 100, 3, 10, 0, None]


def test_funnel_falls(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (None, True)], "a boolean, b boolean")
    free = [r["n"] for r in N.funnel(df, [("all", F.lit(True)), ("a", F.col("a")), ("b", F.col("b"))]).orderBy("step").collect()]
    strict = N.funnel(df, [("all", F.lit(True)), ("a", F.col("a")), ("b", F.col("b"))], cumulative=True).orderBy("step").collect()
    assert free == [4, 2, 3] and [r["n"] for r in strict] == [4, 2, 1]
    assert [r["pct_of_previous"] for r in strict] == [100.0, 50.0, 50.0] and [r["dropped"] for r in strict] == [0, 2, 1]
    empty = N.funnel(df.limit(0), [("all", F.lit(True)), ("a", F.col("a"))]).orderBy("step").collect()
    assert [r["pct_of_first"] for r in empty] == [0.0, 0.0]


def test_page_items():
    html = """<ul><li class="card new" data-no="7"><em class="big place"> 1 </em><a href="/x">A &amp; B<b>!</b></a><img src="i.png">
              <span class="price">1,000</span></li><li class="ad">no</li><li class="card"><a href="/y">C</a></li></ul>"""
    fields = [("", "", "data-no"), ("em", "place", "text"), ("a", "", "href"), ("a", "", "text"), ("img", "", "src"), ("span", "price", "text")]
    assert P.page_items(html, ("li", "card"), fields) == [["7", "1", "/x", "A & B!", "i.png", "1,000"], [None, None, "/y", "C", None, None]]
    assert P.page_items(None, ("li", ""), fields) == [] and P.page_items("<p>", ("li", ""), fields) == []


def test_pages_as_browsers_read_them(spark):
    html = """<HTML data-lang="x" LANG='ko'><HEAD><TITLE>A &amp; B &copy; &#8217;&#x41;</TITLE ><META content="it's &lt;ok&gt;" data-x="1" NAME='description'>
              <a data-href="no" href="?a=1&amp;b=2">x</a><A HREF='/y'>y</A><area href="/area"><h1 class="a">H&eacute;</h1>&nbsp;z"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "k int, h string")
    rows = {r["k"]: r for r in P.extract_page(df, "k", "h").collect()}
    r = rows[1]
    assert (r["title"], r["lang"], r["description"], r["links"], r["heading"]) == ("A & B © ’A", "ko", "it's <ok>", ["?a=1&b=2", "/y"], "Hé")
    assert r["text"].endswith("Hé z") and rows[2]["title"] is None and rows[3]["links"] == []


def test_crosstab_totals_count_unlisted_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("b", "z"), (None, "x")], "r string, c string")
    got = {r["r"]: (r["x"], r["total"]) for r in X.crosstab(df, "r", "c", ["x"], margins=True).collect()}
    assert got == {"a": (1, 3), "b": (0, 1), "total": (1, 4)}


def test_csv_encodings_marks_and_archives(spark, tmp_path):
    import io
    import zipfile

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes("k,v\n1,한글\n".encode("utf-8-sig"))
    (tmp_path / "in" / "b.csv").write_bytes("k,v\n2,한글\n".encode("cp949"))
    got = readers.read_csv(spark, str(tmp_path / "in"), "k int, v string", fallback="cp949")
    assert sorted(map(tuple, got.collect())) == [(1, "한글"), (2, "한글")]
    with pytest.raises(Exception, match="decode"):
        readers.read_csv(spark, str(tmp_path / "in" / "a.csv"), "k int, v string", encoding="cp949").collect()

    writers.write_csv(got, str(tmp_path / "out"), mark=True)
    first = [f.read_bytes()[:3] for f in (tmp_path / "out").glob("*.csv")]
    assert first and set(first) == {b"\xef\xbb\xbf"}
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "out"), "k int, v string").collect())) == [(1, "한글"), (2, "한글")]

    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        z.writestr("a.csv", 'k,v\n1,"one\ntwo"\n2,x\n'.encode("utf-8-sig"))
        z.writestr("b.csv", 'v,other,k\n한글,?,3\n,,4\n'.encode("cp949"))
        z.writestr("c.txt", "no")
    (tmp_path / "z.zip").write_bytes(blob.getvalue())
    got = readers.read_zipped_csv(spark, str(tmp_path / "z.zip"), ".csv", "k int, v string", ["utf-8-sig", "cp949"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [(1, "one\ntwo"), (2, "x"), (3, "한글"), (4, None)]


def test_append_new_returns_the_number_added(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e"), (4, "f")], "k int, v string")
    assert writers.append_new(spark, path, new, ["k"], [F.col("v")]) == 2
    assert writers.append_new(spark, path, new, ["k"], [F.col("v")]) == 0
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "d"), (4, "f")]


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, None)], "k int, v string")
    rep = {r["key_set"]: tuple(r)[1:] for r in A.duplicate_report(df, {"all": ["k", "v"], "k": ["k"]}).collect()}
    assert rep == {"all": (4, 2, 1), "k": (4, 3, 2)}
    assert {r["column"]: (r["nulls"], r["null_pct"]) for r in A.null_report(df).collect()} == {"k": (0, 0.0), "v": (2, 50.0)}
    assert [tuple(r) for r in A.null_report(df.limit(0), ["k"]).collect()] == [("k", 0, 0, None)]


def test_merge(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, ver int, x string")
    new = spark.createDataFrame([(1, 2, "c"), (1, 3, "d"), (2, 4, "e"), (3, 1, "f")], "k int, ver int, x string")
    up = {r["k"]: r["x"] for r in writers.upsert_latest(old, new, ["k"], [F.col("ver")]).collect()}
    assert up == {1: "d", 2: "b", 3: "f"}
    assert [tuple(r) for r in writers.insert_new(old, new, ["k"], [F.col("ver")]).collect()] == [(3, 1, "f")]


def test_csv_with_a_byte_order_mark_and_other_encodings(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿k,v\n한글,1\n".encode())
    (tmp_path / "kr.csv").write_bytes("k,v\n한글,2\n\"똠,방\",3\n,4\n".encode("cp949"))
    schema = "k string, v int"
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "bom.csv"), schema).collect()] == [("한글", 1)]
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "kr.csv"), schema, "cp949").collect()] == [("한글", 2), ("똠,방", 3), (None, 4)]


def test_zip_of_several_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.csv", "k,v\na,1\n\"b,c\",2\n")
        z.writestr("two.csv", "k,v\r\nd,3\r\n")
        z.writestr("empty.csv", "")
        z.writestr("notes.txt", "k,v\nz,9\n")
    got = readers.read_zipped_csv(spark, str(tmp_path / "*.zip"), ".csv", "k string, v int").collect()
    assert sorted(tuple(r) for r in got) == [("a", 1), ("b,c", 2), ("d", 3)]


def test_geojson(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"type":"FeatureCollection",\n"features":[{"type":"Feature","properties":{"code":"11","name":"가나"},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    row = readers.read_features(spark, str(tmp_path / "f.json")).first()
    assert row["properties"] == {"code": "11", "name": "가나"} and row["coordinates"] == "[1,2]"


def test_json_keeps_empty_and_broken_records(spark):
    df = spark.createDataFrame([(1, '{"a":[{"b":1},{"b":2}]}'), (2, '{"a":[]}'), (3, "broken")], "id int, j string")
    out = readers.flatten_json(df, "j", "a array<struct<b:int>>", {"b": C.col("item.b")}, "j.a", ["id"])
    assert sorted((r["id"], r["b"] or 0) for r in out.collect()) == [(1, 1), (1, 2), (2, 0), (3, 0)]


def test_filters_and_columns_reach_the_scan(spark, folder):
    t = Tables(spark, folder)
    p = plan(cleaning.slice_by(t.lineitem, l_returnflag="R").groupBy("l_suppkey").agg(F.sum("l_quantity")))
    assert "EqualTo(l_returnflag,R)" in p and "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_returnflag:string>" in p
