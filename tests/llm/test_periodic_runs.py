import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from helpers import DOCS, SPACED, awkward_docs
from millrace.llm import periodic_runs
from millrace.llm.queries import QUERIES


def all_runs(words, shortest=12):
    """Every lag's stretches of equal words, and each stretch's smallest period by trying them all."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    out = []
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[0], w[:-q] == w[q:], [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(same))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(shortest, 2 * q) and not any((w[a : b + q - p] == w[a + p : b + q]).all() for p in range(1, q)):
                out.append((a, b - a + q, q))
    return sorted(out)


def broken(doc_id, words):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def digest(doc_id, text):
    words = broken(doc_id, SPACED.findall(text or ""))
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(collapsed(words, runs)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op12_periodic_runs"](spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = rows_of(got)
    assert rows == sorted((digest(d, t) for d, t in docs), key=str)
    assert sum(r[1] > 0 for r in rows) >= 10


def find(*texts, shortest=12):
    """Runs of several word lists searched together."""
    number, flat, starts = {}, [], []
    for words in texts:
        starts.append(len(flat))
        flat += [number.setdefault(w, len(number)) for w in words]
    bounds = [*starts, len(flat)]
    out = [[] for _ in texts]
    for a, n, q in periodic_runs.find_runs(np.array(flat, np.int64), np.array(starts, np.int64), shortest):
        k = max(i for i, s in enumerate(starts) if s <= a < bounds[i + 1])
        out[k].append((a - starts[k], n, q))
    return out


def some_texts(seed):
    r = random.Random(seed)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 700:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts = [fibonacci[-1][:700], "a" * 500, "ab" * 200 + "a", "", "x", "a" * 11, "a" * 12, "aab" * 4, "abcdef" * 2, "abcdefg" * 2, "abcdefg" * 2 + "a", ("a" * 90 + "b") * 6]
    texts.append("".join("ab"[bin(i).count("1") % 2] for i in range(2048)))  # no cubes, many squares
    for _ in range(60):
        letters = r.choice(["ab", "abc", "abcdefgh"])
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 120)))
        for _ in range(r.randint(0, 4)):
            part, at = "".join(r.choice(letters) for _ in range(r.randint(1, 60))), r.randint(0, len(text))
            text = text[:at] + part * r.randint(2, 5) + part[: r.randint(0, len(part))] + text[at:]
        texts.append(text)
    return texts


@pytest.mark.parametrize("shortest", [12, 2, 5, 31])
def test_runs_equal_brute_force(shortest):
    texts = some_texts(shortest)
    assert find(*texts, shortest=shortest) == [all_runs(t, shortest) for t in texts]


def test_long_texts_take_time_in_proportion():
    r = random.Random(9)
    block = [str(r.random()) for _ in range(300)]
    cases = [["a"] * 400_000, block * 1_000, [str(r.random()) for _ in range(300_000)], (["a"] * 700 + ["b"]) * 300]
    for words in cases:
        began = time.time()
        (runs,) = find(words)
        assert time.time() - began < 30
        for a, n, q in runs:
            assert words[a : a + n - q] == words[a + q : a + n]
    assert find(cases[0]) == [[(0, 400_000, 1)]]
    assert find(cases[1]) == [[(0, 300_000, 300)]]


def test_awkward_texts(spark):
    rows = awkward_docs() + [(30, "\tto be\x0bor not " * 40, "en", "s", 1), (31, "é " * 30 + "ü " * 11, "en", "s", 1), (31, "a b " * 9, "en", "s", 1), (32, "x\x1cy " * 20 + "\xa0", "en", "s", 1)]
    df = spark.createDataFrame([(*r, "n") for r in rows], DOCS + ", runs string").repartition(3)
    want = []
    for d, t, *_ in rows:
        words = SPACED.findall(t or "")
        runs = all_runs(words) if len(words) < 20_000 else []
        want.append((d, len(words), runs, collapsed(words, runs)))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(df).collect()), key=str)
    assert [g for g in got if g[1] < 20_000] == sorted((w for w in want if w[1] < 20_000), key=str)
    # the long texts repeat 5,003 words
    for d, n, runs, text in got:
        if n >= 20_000:
            assert runs == [(0, 30_000, 5003)] and len(text.split(" ")) == n - 30_000 + 5003
    again = periodic_runs.run_digest(periodic_runs.periodic_runs(periodic_runs.planted(df)))
    assert rows_of(again.where("doc_id is null or doc_id not in (4, 12)")) == sorted((digest(r[0], r[1]) for r in rows if r[0] not in (4, 12)), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert periodic_runs.run_digest(periodic_runs.periodic_runs(periodic_runs.planted(empty))).collect() == []
