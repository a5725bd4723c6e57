import hashlib
import random

import numpy as np
import pytest

from helpers import ALNUM, LOWER, alnum_words, awkward_docs, benchmark_windows, frame, passages
from millrace.llm import decontaminate
from millrace.llm.fm_index import FMIndex, suffix_order
from millrace.llm.queries import QUERIES


def check(rows, docs, items):
    windows = benchmark_windows(items)
    got = sorted((r for r in rows), key=str)
    want = []
    for d, t in docs:
        n, hit, found = passages(t, windows)
        ids = ",".join(sorted(map(str, found)))
        want.append((d, n, len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    check(QUERIES["op7_benchmark_passages"](spark, folder).collect(), docs, items)


ITEMS = [(1, "One TWO"), (2, None), (3, ""), (4, "..."), (5, " ".join(f"base{k}" for k in range(5, 30))), (5, "kataka"), (10, "ñandú x"), (6, "line one of many words here line one of many words here line")]


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_awkward_rows_and_blocks(spark, block):
    rows = awkward_docs()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows).withColumnRenamed("lang", "spans"), bench, block_words=block).collect()
    check(got, [(d, t) for d, t, *_ in rows], ITEMS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(frame(spark), none).collect())
    assert decontaminate.contamination(frame(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []


def test_cleaned_texts_hold_no_window(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    windows = benchmark_windows(ITEMS)
    rows = {(r.doc_id, r.rest.n_chars): r for r in decontaminate.cleaned_texts(frame(spark), bench, carry=["n_chars"]).collect()}
    for d, t, _, _, n in awkward_docs():
        _, hit, _ = passages(t, windows)
        r = rows[d, n]
        assert r.n_hit == len(hit)
        if not hit:
            assert r.text == t
        else:
            assert alnum_words(r.text) == [w for k, w in enumerate(alnum_words(t)) if k not in hit]
            assert not passages(r.text, windows)[1]


def test_words():
    text = "Ab-cD ÉÄ_x\x00y 12é\x7f"
    assert [w.decode() for w in decontaminate.words_of(text)] == ALNUM.findall(text.translate(LOWER))


def test_index_against_scan():
    rng = np.random.default_rng(0)
    for _ in range(200):
        text = rng.integers(0, 4, rng.integers(1, 60))
        text[-1] = 0
        order = suffix_order(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        index = FMIndex(text)
        patterns = [rng.integers(1, 5, rng.integers(1, 4)) for _ in range(10)]
        table = np.zeros((10, 3), int)
        for n, p in enumerate(patterns):
            table[n, : len(p)] = p
        low, high = index.search(table, np.array([len(p) for p in patterns]))
        for n, p in enumerate(patterns):
            want = [k for k in range(len(text) - len(p) + 1) if (text[k : k + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(low[n], max(low[n], high[n]))).tolist()) == want


def test_small_shards(spark, monkeypatch):
    random.seed(2)
    docs = [(d, " ".join(random.choice("abc") for _ in range(random.randrange(80)))) for d in range(150)]
    items = [(k, " ".join(random.choice("abc") for _ in range(random.choice([2, 5, 10, 14])))) for k in range(30)]
    monkeypatch.setattr(decontaminate, "SHARD", 200)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, [(d, t, "x", "s", 1) for d, t in docs]), bench).collect()
    check(got, docs, items)
