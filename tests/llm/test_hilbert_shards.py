import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import DOCS, awkward_docs, frame
from millrace.llm import hilbert_shards
from millrace.llm.queries import QUERIES


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2), (5, 2)])
def test_the_curve_visits_neighbours(spark, dims, bits):
    """All cells once, each next to the one before."""
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{k} int" for k in range(dims)))
    place = hilbert_shards.hilbert_index([F.col(f"c{k}") for k in range(dims)], bits)
    rows = sorted(df.select(place.alias("p"), *df.columns).collect())
    assert [r.p for r in rows] == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1 for a, b in zip(rows, rows[1:]))


def check(rows, docs, count, law):
    """rows: the operator's; docs: [(doc_id, text)]."""
    expect = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expect
    by = defaultdict(list)
    for r in rows:
        assert r.law == law and r.grown_shard is None and 0 <= r.shard < count
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [len(by[s]) if law == "rows" else sum(r.size for r in by[s]) for s in range(count)]
    assert max(sizes) - min(sizes) <= (1 if law == "rows" else 2 * max(r.size for r in rows))
    last = ()
    for s in range(count):  # the runs follow the curve, ties by text and id
        for r in sorted(by[s], key=lambda r: r.slot):
            key = (r.place, r.text_crc32, r.doc_id is not None, r.doc_id or 0, r.size)
            assert key >= last
            last = key


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = QUERIES["op11_hilbert_shards"](spark, folder)
    assert got.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert dict(got.dtypes) | {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"} == dict(got.dtypes)
    check(got.collect(), [(r.doc_id, r.text) for r in docs], 40, "rows")


def expected_place(spark, rows, bits):
    """Cells by sorting all values, for columns lang, source, n_chars."""
    codes = []
    for k in (2, 3, 4):
        values = sorted(r[k] for r in rows if r[k] is not None)
        cells = defaultdict(list)
        for i, v in enumerate(values):
            if i + 1 == len(values) or values[i + 1] != v:
                cells[i * (1 << bits) // len(values)].append(v)
        bounds = sorted(max(c) for c in cells.values())[:-1]
        codes.append([0 if r[k] is None else sum(b < r[k] for b in bounds) for r in rows])
    return list(zip(*codes))


@pytest.mark.parametrize("law,count", [("rows", 7), ("bytes", 4), ("rows", 100), ("rows", 1)])
def test_awkward_documents(spark, law, count):
    rows = awkward_docs() + [(None, None, None, None, None)] * 50 + [(77, "same text", "en", "hot", 9)] * 400
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", shard int, place int").repartition(5)
    out = hilbert_shards.shard_documents(df, ["lang", "source", "n_chars"], count, law, bits=3, carry=True)
    got = out.collect()
    check(got, [r[:2] for r in rows], count, law)
    cells = expected_place(spark, rows, 3)
    places = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, a int, b int, c int")
    places = dict(places.select("i", hilbert_shards.hilbert_index([F.col("a"), F.col("b"), F.col("c")], 3)).collect())
    assert Counter((r.doc_id, r.place) for r in got) == Counter((r[0], places[i]) for i, r in enumerate(rows))
    assert Counter(tuple(r.row) for r in got) == Counter((*r, 1, 2) for r in rows)


def test_written_shards_can_be_skipped(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    dims = ["lang", "source", "n_chars"]
    out = hilbert_shards.shard_documents(docs.withColumn("shard", F.lit("own")), dims, 40, carry=True)
    name = hilbert_shards.write_shards(out, f"{tmp_path}/h", 40)
    assert name == "shard_"
    back = spark.read.parquet(f"{tmp_path}/h")
    assert Counter(tuple(r) for r in back.select(*docs.columns).collect()) == Counter(tuple(r) for r in docs.collect())
    ranges = hilbert_shards.shard_ranges(spark, f"{tmp_path}/h", dims, "shard_").collect()
    assert len(ranges) == 40 and sum(r.n_rows for r in ranges) == docs.count()
    # boxes of one language, source and range of lengths: fewer shards are opened than by order of any one column
    boxes = [(r.lang, r.source, r.n_chars) for r in docs.collect()[::5]]
    opened = sum(r.min_lang <= a <= r.max_lang and r.min_source <= b <= r.max_source and r.min_n_chars <= c <= r.max_n_chars for r in ranges for a, b, c in boxes)
    assert opened / len(boxes) < 8


def test_empty_table_and_wrong_law(spark):
    empty = frame(spark, [])
    assert hilbert_shards.shard_documents(empty, ["lang", "source", "n_chars"], 40).collect() == []
    with pytest.raises(ValueError):
        hilbert_shards.shard_documents(empty, ["lang"], 4, law="none")
