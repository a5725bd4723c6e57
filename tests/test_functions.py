"""Edge cases of the column functions on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import columns as C, dates as D, payload as P, text as X


def one(spark, value, expr, type_="string"):
    return spark.createDataFrame([(value,)], f"x {type_}").select(expr("x").alias("y")).first()["y"]


def test_numbers(spark):
    assert one(spark, "12.5", C.to_number) == 12.5
    for bad in ("abc", "", None, "NaN", "Infinity"):
        assert one(spark, bad, C.to_number) is None
    assert one(spark, " €1,234.50 each ", C.clean_numeric) == 1234.5
    for bad in ("", "none", None, "1.2.3"):
        assert one(spark, bad, C.clean_numeric) is None


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 2.0), (1.0, 3.0), (1.0, 8.0), (-1.0, -0.0)], "a double, b double")
    got = [r[0] for r in df.select(C.safe_ratio("a", "b", 2)).collect()]
    assert got == [None, None, None, 0.33, 0.12, None]


def test_buckets_are_half_open(spark):
    df = spark.createDataFrame([(9.9,), (10.0,), (19.9,), (20.0,), (None,)], "b double")
    got = [r[0] for r in df.select(C.bucketize("b", [10.0, 20.0], ["a", "b", "c"])).collect()]
    assert got == ["a", "b", "b", "c", None]


def test_labels(spark):
    df = spark.createDataFrame([("Öst Süd", None), (None, "x"), ("  a  b c d ", "y")], "k string, v string")
    assert [r[0] for r in df.select(C.compose_key(["k", "v"])).collect()] == ["Öst Süd", "x", "a  b c d  y"]
    parts = df.select(*C.split_label("k", 3)).collect()
    assert tuple(parts[0]) == ("Öst", "Süd", "") and tuple(parts[1]) == ("", "", "") and tuple(parts[2]) == ("a", "b", "c")
    assert [r[0] for r in df.select(C.ordinal("v", ["y", "x"])).collect()] == [2, 1, 0]


def test_filters_keep_null_on_exclusion(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r[0] for r in df.where(C.not_in_values("k", ["a"])).collect()] == ["b", None]
    assert [r[0] for r in df.where(C.in_values("k", ["a"])).collect()] == ["a"]


def test_text(spark):
    assert one(spark, None, lambda c: X.rx_contains(c, "a")) is False
    assert one(spark, "ÉCOLE", lambda c: X.rx_contains(c, "é")) is True
    assert one(spark, "aaaa", lambda c: X.kw_count(c, ["aa"])) == 2
    assert one(spark, "[new] Acme 가위", lambda c: X.leading_brand(c, ["new"])) == "Acme"
    assert one(spark, "[가나다] 가위", lambda c: X.leading_brand(c, ["new"])) == "가나다"
    assert one(spark, "[new]", lambda c: X.leading_brand(c, ["new"])) is None
    assert one(spark, "Acme deluxe", X.leading_brand) == "Acme"
    assert one(spark, None, X.leading_brand) is None
    assert one(spark, "Ça va, l'été_2 !", X.tokens) == ["ça", "va", "l", "été_2"]
    assert one(spark, "http://www.a.b/c", lambda c: X.domain(c, "?")) == "a.b"
    assert one(spark, None, lambda c: X.domain(c, "?")) == "?"
    for bad in (None, "", " nan ", "ftp://x", "0"):
        assert one(spark, bad, lambda c: X.clean_url(c, "d", fillers=["nan", "0"])) == "d"
    assert one(spark, " http://x ", lambda c: X.clean_url(c, "d")) == "http://x"


def test_dates(spark):
    assert one(spark, "20240229", D.ymd) == dt.date(2024, 2, 29)
    for bad in ("20240230", "x", None):
        assert one(spark, bad, D.ymd) is None
    assert one(spark, "Tue, 05 Mar 2019 18:30:00 +0900", lambda c: F.unix_seconds(D.rfc822(c))) == 1551778200
    assert one(spark, "no date", lambda c: F.unix_seconds(D.rfc822(c))) is None
    assert one(spark, dt.date(2024, 1, 6), D.is_weekend, "date") is True
    assert one(spark, "2021 March", D.year_of) == 2021
    assert one(spark, "no year", D.year_of) is None


def test_scores(spark):
    assert one(spark, 100.0, C.rescale5, "double") == 5.0
    assert one(spark, 5.0, C.rescale5, "double") == 5.0
    df = spark.createDataFrame([("10.5,20.25",), ("10.5",), ("a,b",), ("10.5, x",), (None,)], "p string")
    got = [tuple(r) for r in df.select(*C.lat_lon("p")).collect()]
    assert got == [(10.5, 20.25)] + [(None, None)] * 4


def test_numbers(spark):
    for text, want in [("12d", None), ("1.5f", None), ("1e3", 1000.0), (" -2.5 ", -2.5), ("Infinity", None), ("NaN", None), (".5", 0.5), ("5.", 5.0), ("0x10", None), (None, None), ("", None)]:
        assert one(spark, text, C.to_number) == want
    for value, want in [("$ 1,234.50", 1234.5), (" n/a ", None), ("1.2.3", None), (None, None), ("12345678.0", 12345678.0)]:
        assert one(spark, value, C.clean_numeric) == want
    assert one(spark, 12345678.0, C.clean_numeric, "double") == 12345678.0
    assert one(spark, 1e-7, C.clean_numeric, "double") == 1e-7


def test_first_object():
    assert P.first_object('f({x}); y = {"k": [1, {"a": "{"}]} z') == '{"k": [1, {"a": "{"}]}'
    assert P.first_object('\\{"a": 1}') == '{"a": 1}'
    assert P.first_object('x={"a":"}{","b":{"c":1}};{}') == '{"a":"}{","b":{"c":1}}'
    assert P.first_object('{"a":"\\"}"}') == '{"a":"\\"}"}'
    for bad in (None, "", "no", "{", '{"a":"}'):
        assert P.first_object(bad) is None
