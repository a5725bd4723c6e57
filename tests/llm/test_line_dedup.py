import random
import re
from collections import defaultdict

import xxhash

from helpers import awkward_docs, frame
from millrace.llm import line_dedup
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")


def order_of(docs):
    """Documents by id, then by a hash of their texts as the engine has it (ids shared by other texts do not occur below)."""
    return sorted((d, t) for d, t in docs if d is not None and t is not None)


def pairs_of(text):
    """Neighbouring lines with words and what lies between them, by number of the first."""
    lines = text.split("\n")
    worded = [i for i, x in enumerate(lines) if WORD.search(x)]
    return lines, {i: (j, tuple(lines[i : j + 1])) for i, j in zip(worded, worded[1:])}


def brute(docs):
    """Every row with what stays of it."""
    first = {}
    for d, t in order_of(docs):
        for i, (_, pair) in pairs_of(t)[1].items():
            first.setdefault(pair, (d, i))
    out = []
    for d, t in docs:
        if t is None:
            out.append((d, 0, 0, 0, None))
            continue
        lines, pairs = pairs_of(t)
        gone = [False] * len(lines)
        for i, (j, pair) in pairs.items():
            if d is not None and first[pair] < (d, i):
                gone[i : j + 1] = [True] * (j + 1 - i)
        starts = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((d, len(lines), starts, sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(map(str, out))


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows_of(QUERIES["op4_line_chunks"](spark, folder)) == brute(docs)


def passages(seed, sizes=(3, 4, 5, 8, 10, 20, 50)):
    """Documents of own lines with passages of all sizes that others hold too, at shifted places."""
    rng, number, docs, spread = random.Random(seed), 0, [], defaultdict(list)
    own = lambda n: [f"own {rng.random()} line" for _ in range(n)]
    for size in sizes:
        for k in range(20):
            passage = [f"passage {size} {k} line {j}" for j in range(size)]
            for _ in range(3):
                docs.append((number, "\n".join(own(rng.randint(0, 6)) + passage + own(rng.randint(0, 6)))))
                spread[size, k].append(number)
                number += 1
    return docs, spread


def test_recall_over_passages_of_all_sizes(spark):
    """All repeated lines go from all documents but the first; own lines stay."""
    docs, spread = passages(1)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, [(d, t, "x", "s", 1) for d, t in docs])).collect()}
    texts = dict(docs)
    for (size, _), numbers in spread.items():
        assert got[numbers[0]].text == texts[numbers[0]]
        for d in numbers[1:]:
            assert got[d].n_removed_lines == size and got[d].n_removed_chunks == 1
            assert got[d].text == "\n".join(x for x in texts[d].split("\n") if x.startswith("own"))


def test_awkward_rows(spark):
    rng = random.Random(3)
    passage = "\n".join(" ".join(f"p{k}.{j}" for j in range(8)) for k in range(24))
    rows = [r for r in awkward_docs() if r[0] != 7] + [(7, "a\n\n b\n\nc", "x", "s", 1)] * 2
    for d in range(30, 60):
        own = "\n".join(" ".join(f"o{d}.{k}.{j}" for j in range(6)) for k in range(rng.randrange(8)))
        rows.append((d, f"{own}\n{passage}\nend {d}\n\nc\n\t\n\n b", "x", "s", 1))
    docs = frame(spark, rows).withColumnRenamed("lang", "lines").withColumnRenamed("source", "gone")
    assert rows_of(line_dedup.dedup_lines(docs)) == brute([(d, t) for d, t, *_ in rows])
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_rows_of_one_id(spark):
    """Texts that share an id are documents of their own: one of them keeps what both hold."""
    rows = [(1, "same\nlines\nhere\nfirst own", "x", "s", 1), (1, "second own\nsame\nlines\nhere", "x", "s", 1), (None, "same\nlines\nhere", "x", "s", 1)]
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()]
    assert (None, "same\nlines\nhere") in got
    assert sorted(t for d, t in got if d == 1) in (["first own", rows[1][1]], sorted([rows[0][1], "second own"]))


def test_equal_digests_of_other_bytes(spark, monkeypatch):
    """With a digest that hardly tells windows apart, the bytes still do."""
    monkeypatch.setattr(xxhash, "xxh3_128_digest", lambda body: bytes([len(body) % 3]))
    docs, _ = passages(2, (3, 6))
    lines = [(d, t, "x", "s", 1) for d, t in docs]
    df = frame(spark, lines)
    monkeypatch.setattr(line_dedup, "_per_row", in_driver(spark))
    assert rows_of(line_dedup.dedup_lines(df)) == brute(docs)


def in_driver(spark):
    """What the tasks do, done here, where the digest is replaced."""

    def per_row(docs, make, schema, types):
        return spark.createDataFrame([r for x in docs.collect() for r in make(x.asDict())], schema)

    return per_row


def test_a_long_text_of_repeated_lines(spark):
    text = "\n".join(f"line {k % 500}" for k in range(60_000))
    (row,) = line_dedup.dedup_lines(frame(spark, [(1, text, "x", "s", 1)])).collect()
    assert row.text == "\n".join(f"line {k}" for k in range(500)) and row.n_removed_lines == 59_500


def test_short_lines(spark):
    """Menus and footers of few words go like any other repeated chunk; blank lines stay."""
    menu = "Home\nAbout\nContact\nLog in"
    rows = [(d, menu, "x", "s", 1) for d in range(1, 6)] + [(d, "\n\n\n", "x", "s", 1) for d in (6, 7)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got[1].text == menu and got[1].n_removed_lines == 0
    assert all(got[d].n_removed_lines == 4 and got[d].text == "" for d in range(2, 6))
    assert all(got[d].text == "\n\n\n" for d in (6, 7))
