from collections import Counter

import corpus_pipeline
from helpers import alnum_words, awkward_docs, benchmark_windows, components, frame, passages, statistics, token_rows
from millrace.llm.shared import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run_stages(spark, docs, folder):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], folder), "test"))
    return out


def check(spark, folder, docs):
    start, good, single, clean, mixed, files = run_stages(spark, docs, folder)
    rows = [d.collect() for d in (start, good, single, clean, mixed)]
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for d in (good, single, clean, mixed):
        assert d.columns == docs.columns
    # quality: only rows of the input, none that a text rule rejects
    assert not Counter(rows[1]) - Counter(rows[0])
    assert not any(statistics(r.text)[-1] for r in rows[1])
    # near duplicates: the first of each component; rows that share an id or have none come behind all others
    often = Counter(r.doc_id for r in rows[1])
    ranked = sorted(rows[1], key=lambda r: (r.doc_id is None or often[r.doc_id] > 1, r.doc_id or 0))
    want = components([(k, r.text) for k, r in enumerate(ranked)])
    first = [ranked[k] for k, c in want.items() if k == c]
    assert len(rows[2]) == len(first) and not Counter(rows[2]) - Counter(rows[1])
    assert sorted(r.doc_id for r in rows[2] if often[r.doc_id] == 1) == sorted(r.doc_id for r in first if often[r.doc_id] == 1)
    # benchmark: same documents, hit words gone, others as they were
    windows = benchmark_windows([(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    clean = []
    for r in rows[2]:
        _, hit, _ = passages(r.text, windows)
        words = [w for k, w in enumerate(alnum_words(r.text)) if k not in hit]
        if not hit or words:
            clean.append((r.doc_id, tuple(words) if hit else r.text))
    hits = {d for d, t in clean if isinstance(t, tuple)}
    assert Counter(clean) == Counter((r.doc_id, tuple(alnum_words(r.text)) if r.doc_id in hits and (r.doc_id, tuple(alnum_words(r.text))) in set(clean) else r.text) for r in rows[3])
    assert all(r.n_chars == len(r.text) for r in rows[3] if r.doc_id in hits and r.text is not None)
    # mixing: rows of the input, at most MAX_EPOCHS times
    times, there = Counter(rows[4]), Counter(rows[3])
    assert set(times) <= set(there) and all(n <= corpus_pipeline.MAX_EPOCHS * there[r] for r, n in times.items())
    # token files
    got = files.collect()
    plain = lambda x: sorted((str(r[0]), r[2], r[3]) for r in x)
    assert plain(got) == plain(token_rows([(r.doc_id, r.text) for r in rows[4]], corpus_pipeline.TOKENIZER))
    got = sorted(got, key=lambda r: r.start)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check(spark, folder, docs)


def test_awkward_rows(spark, folder):
    """Nulls, repeated rows and clashing columns beside clean documents."""
    real = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    rows = [(d if d is None else d + 10_000, *rest) for d, *rest in awkward_docs()] + real + real[:5]
    docs = frame(spark, rows).selectExpr("*", "source as domain", "lang as spans", "1 as _copies", "lang as row_key")
    check(spark, folder, docs)


def test_rows_that_share_an_id(spark, folder):
    """Texts of rows without an id, or with one that others have, are not lost and not multiplied."""
    texts = [f"{w} " + " ".join(f"{w}{k}" for k in range(60)) for w in ("one", "two", "three", "four")]
    rows = [(1, texts[0]), (7, texts[1]), (7, texts[2]), (None, texts[3]), (None, texts[3]), (None, texts[0]), (7, texts[1]), (9, None), (None, None)]
    docs = frame(spark, [(d, t, "en", "source0", 1) for d, t in rows])
    single = corpus_pipeline.near_duplicates(spark, docs, folder)
    want = [(None, None), (None, texts[3]), (1, texts[0]), (7, texts[1]), (7, texts[2]), (9, None)]
    assert sorted(((r.doc_id, r.text) for r in single.collect()), key=str) == sorted(want, key=str)
    mixed = corpus_pipeline.mixing_sources(spark, written(single, "test"), folder).collect()
    assert sorted(((r.doc_id, r.text) for r in mixed), key=str) == sorted(want, key=str)
    far = corpus_pipeline.near_duplicates(spark, docs.union(frame(spark, [((1 << 63) - 1, texts[0], "en", "s", 1)])), folder).collect()
    assert sorted(r.text for r in far if r.text) == sorted(texts)


def test_empty_table(spark, folder):
    assert run_stages(spark, frame(spark, []), folder)[-1].collect() == []


def test_run(spark, folder):
    import __spark_entry__ as e

    rows = e.queries()["pipeline"](spark, folder).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "n_tokens", "ids_crc32"}
    assert {f"op{n}_" for n in range(1, 11)} <= {k[: k.index("_") + 1] for k in e.queries() if k.startswith("op")}


def test_the_driver_collects_between_stages(spark, folder, monkeypatch):
    """A stage finds no heap that the plans of the stages before it have grown."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    collections = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    seen = []

    def stage(spark, docs, folder):
        seen.append(collections())
        return docs.limit(5)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("stage", stage)] * 4)
    assert corpus_pipeline.run(spark, folder).count() == 5
    assert len(seen) == 4 and all(a < b for a, b in zip(seen, seen[1:]))
