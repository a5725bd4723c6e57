import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import awkward_docs, frame, statistics
from millrace.llm import quality, shared
from millrace.llm.queries import QUERIES

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def stats_of(r):
    return tuple(r[c] for c in COLUMNS)


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_rules"](spark, folder).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        assert stats_of(r) == statistics(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    judged = [r for r in rows if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in judged if labels[r.doc_id] == 1]
    assert sum(good) >= 0.98 * len(good)


def test_held_out_accuracy(spark):
    """Fitted on half of the labels of a larger table, judged on the other half."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.quality(docs, None, model=model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality == 1 and not r.base_failed], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def same(a, b):
    return sorted(map(str, a)) == sorted(map(str, b))


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(5, 1), (15, 0), (None, 1), (4, None), (5, 1)], "doc_id long, quality int")
    docs = frame(spark).withColumnRenamed("lang", "words").withColumnRenamed("source", "kept")
    rows = quality.quality(docs, labels).collect()
    assert same([(r.doc_id, *stats_of(r)) for r in rows], [(d, *statistics(t)) for d, t, *_ in awkward_docs()])
    carried = quality.quality(docs, labels, carry=True).select("row.*")
    assert carried.columns == docs.columns and same(carried.collect(), docs.collect())


def test_repeats_against_brute_force(spark):
    random.seed(1)
    rows = [(d, " ".join(random.choice("abcd") for _ in range(random.randrange(90))), "x", "s", 1) for d in range(200)]
    got = quality.quality(frame(spark, rows), None, model=quality.QualityModel([0.0] * quality.BUCKETS, 0.0)).collect()
    assert {r.doc_id: stats_of(r) for r in got} == {d: statistics(t) for d, t, *_ in rows}


def test_score_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(frame(spark), labels)
    assert model.threshold == 0.0 and set(model.weights) == {0.0}
    assert quality.quality(frame(spark, []), labels).collect() == []
    # one weight everywhere gives that score at any length
    flat = quality.QualityModel([-0.5] * quality.BUCKETS, -math.inf)
    for r in quality.quality(frame(spark), None, model=flat).collect():
        assert r.score == pytest.approx(-0.5) or r.n_words == 0


def test_every_label_takes_part(spark):
    """Labels of 60,000 documents, 120 of which are there: all of these are trusted, not a sample of the labels."""
    random.seed(2)
    docs = frame(spark, [(d * 500, " ".join(f"{'good' if d < 120 else 'bad'}{random.randrange(40)}" for _ in range(60)), "x", "s", 1) for d in range(240)])
    few = spark.createDataFrame([(d * 500, 1) for d in range(120)], "doc_id long, quality int")
    many = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    want, got = quality.fit_quality(docs, few), quality.fit_quality(docs, many)
    assert got == want and max(got.weights) > 0


def test_threshold_by_brute_force(spark):
    """The threshold lies below the score of all but the least share of the held-out half."""
    random.seed(3)
    docs = frame(spark, [(d, " ".join(f"w{random.randrange(300)}" for _ in range(80)), "x", "s", 1) for d in range(600)])
    labels = docs.select("doc_id", F.lit(1).alias("quality")).where("doc_id < 400")
    model = quality.fit_quality(docs, labels)
    held = quality.quality(docs, None, model=quality.QualityModel(model.weights, 0.0)).join(labels, "doc_id")
    held = sorted(r.score for r in held.where(F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 1).collect())
    at = quality.LOST_SHARE * (len(held) - 1)
    assert model.threshold == pytest.approx(min(0.0, held[0] + (held[1] - held[0]) * at - quality.MARGIN))


def test_documents_marked_by_chance_are_not_counted(spark, monkeypatch):
    """With a bitmap of 64 bits nearly every document is marked; only the labelled ones count as trusted."""
    random.seed(4)
    docs = frame(spark, [(d, " ".join(f"{'good' if d % 3 else 'bad'}{random.randrange(40)}" for _ in range(60)), "x", "s", 1) for d in range(300)])
    labels = docs.where("doc_id % 3 > 0").select("doc_id", F.lit(1).alias("quality"))
    want = quality.fit_quality(docs, labels)
    monkeypatch.setattr(shared, "FILTER_BITS", 64)
    assert quality.fit_quality(docs, labels) == want


def test_plans_do_not_hold_the_weights(spark):
    """Ten thousand numbers in a plan are megabytes of texts that the driver makes and keeps."""
    docs = frame(spark, [(1, "some words here", "en", "s", 3), (2, None, "en", "s", 3)])
    model = quality.QualityModel([0.1234567890123 * (k % 7 - 3) for k in range(quality.BUCKETS)], 0.0)
    scored = quality.quality(docs, None, model=model)
    assert [r.score for r in scored.orderBy("doc_id").collect()][1] == 0.0
    assert len(scored._jdf.queryExecution().toString()) < 100_000
