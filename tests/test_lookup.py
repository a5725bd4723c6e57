"""Names and patterns in texts against trying them one by one."""

import random
import re

import pytest

from millrace.operators import joins, lookup, rules


@pytest.mark.parametrize(
    "pattern,literal",
    [("abc", "abc"), ("ABc", "abc"), (r"\babc\b", "abc"), ("a.cde", "cde"), ("(foo|bar)bazz", "bazz"), ("x+yz", "yz"), ("(abcd)+e", "abcd"), ("(abcd)*e", "e"), ("(?:ab){2}", "ab"),
     ("foo|bar", ""), (r"\d+", ""), ("[ab]cd", "cd"), ("한글abc", "abc"), ("^a$", "a"), ("(?=long)ab", "ab"), ("a(?>bcd)e", "bcd"), (".*", "")],
)
def test_needed_literal(pattern, literal):
    assert lookup.needed_literal(pattern) == literal


def some(rng, n, letters="abcdeıſKé "):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_names(spark, monkeypatch, block):
    monkeypatch.setattr(lookup, "BLOCK_CHARS", block)
    rng = random.Random(3)
    names = [(some(rng, rng.randint(1, 5)), rng.choice([None, 1, 2, 3, 9]), f"p{k}") for k in range(60)] + [(None, 0, "x")]
    texts = [(k, some(rng, rng.randint(0, 30)).upper() if k % 2 else some(rng, 20), "own") for k in range(300)] + [(1000, None, "n"), (1001, "", "e")]
    df = spark.createDataFrame(texts, "k long, t string, _p0 string").repartition(3)
    cat = spark.createDataFrame(names, "name string, o int, what string")
    lower = {r.t: r.l for r in df.selectExpr("t", "lower(t) as l").collect()}
    small = {r.name: r.l for r in cat.selectExpr("name", "lower(name) as l").collect()}
    first = {}
    for n, o, p in names:
        key = (o is not None, o or 0)
        if n is not None and len(small[n]) >= 2 and (small[n] not in first or key < first[small[n]][0]):
            first[small[n]] = (key, p)
    equal = {}
    for n, o, p in names:
        if n is not None:
            equal.setdefault((small[n], o), set()).add(p)
    got = {r.k: r for r in joins.contains_join(df, "k", "t", cat, "name", "o", ["what"]).collect()}
    assert len(got) == len(texts)
    for k, t, own in texts:
        hits = sorted((key, n) for n, (key, _) in first.items() if t is not None and n in lower[t])
        assert got[k].t == t and got[k]._p0 == own
        if not hits:
            assert got[k].what is None
        else:
            (present, o), n = hits[0]
            assert got[k].what in equal[n, o if present else None]
    assert joins.contains_join(df, "k", "t", cat.where("false"), "name", "o", ["what"]).where("what is not null").count() == 0


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_patterns(spark, monkeypatch, block):
    monkeypatch.setattr(lookup, "BLOCK_CHARS", block)
    rng = random.Random(4)
    parts = ["ab", "c+", "[de]", r"\b", r"\s", "a?", "(bc|d)", ".", "K", "s", "i", "(?:ea){1,2}", "e*", "é"]
    table = {"".join(rng.choice(parts) for _ in range(rng.randint(1, 5))): k for k in range(80)}
    rows = [(o, f"l{o}", p) for p, o in table.items()] + [(7, "again", next(iter(table)))]
    texts = [(k, some(rng, rng.randint(0, 12), "abcdeıſKkKSsIİé \n")) for k in range(400)] + [(900, None)]
    df = spark.createDataFrame(texts, "k long, t string").repartition(3)
    out = rules.classify_by_patterns(df, "k", "t", spark.createDataFrame(rows, "ord long, label string, pattern string"), "none")
    ordered = sorted((o, f"l{o}", re.compile(p, re.I)) for p, o in table.items())
    for r in out.collect():
        assert r.label == next((label for _, label, p in ordered if r.t is not None and p.search(r.t)), "none")


def test_no_row_per_character_is_shuffled(spark):
    texts = spark.range(100).selectExpr("id", "repeat('word ', 100) as t")
    cat = spark.createDataFrame([("word", 1, "w")], "name string, o int, what string")
    plan = joins.contains_join(texts, "id", "t", cat, "name", "o", ["what"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "NestedLoop" not in plan and "Generate" not in plan
