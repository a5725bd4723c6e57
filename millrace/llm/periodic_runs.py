"""Runs of periodic words in documents, found by seeds and their extension.

A run is a stretch of words that repeats with a period: words ``period`` apart
are equal, it is as long as that lasts, has no smaller period, and holds at least
two periods and ``shortest`` words. Seen as pairs of places, a run of period q
is a stretch of a diagonal (places i and i + q) of at least
``max(q, shortest - q)`` matches.

Lags are taken in classes [Q, 2Q). Every stretch of the class's guaranteed
length m holds a k-gram that starts at a multiple of k, for k = (m + 1) // 2. So
only those k-grams are seeds; an index of all k-grams gives each seed its other
occurrences within the class's lags, at most about four a word, whatever
the text. A pair is extended both ways unless the table of its lag says that the
place is covered already, or it lies in a known run whose period divides the lag
and so is no run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shared import hand_back, light_batches, only

SHORTEST = 12
GROUP_BYTES = 4_000_000
PAIRS = 1_000_000
# odd, so that products modulo 2**64 lose nothing; equal hashes are compared word by word
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def classes(shortest: int, longest: int) -> Iterator[tuple[int, int]]:
    """Lags [Q, 2Q) by Q, with the fewest matches of any run in the class."""
    q = 1
    while 2 * q <= longest:
        yield q, min(max(p, shortest - p) for p in range(q, min(2 * q, max(q, shortest) + 1)))
        q *= 2


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive words, by doubling."""
    n = len(words) - k + 1
    out, done, power = None, 0, words
    size = 1
    while True:
        if k & size:
            part = power[done : done + n]
            out = part if out is None else out * FACTOR + (part ^ (part >> np.uint64(29)))
            done += size
        if done == k:
            return out
        power = power[: len(power) - size] * FACTOR + (power[size:] ^ (power[size:] >> np.uint64(31)))
        size *= 2


def _seeds(words: np.ndarray, ends: np.ndarray, q: int, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a place and a lag in [q, 2q) whose k-grams look equal, place by place."""
    k = (m + 1) // 2
    if len(words) < k + q:
        return
    bits = np.uint64(len(words).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    grams = (_grams(words, k) * FACTOR) & ~low
    index = np.sort(grams | np.arange(len(grams), dtype=np.uint64))
    place = (index & low).astype(np.int64)
    # a seed's next occurrence is near enough and in its own document
    near = np.flatnonzero(((index[1:] ^ index[:-1]) <= low) & (place[1:] - place[:-1] < 2 * q) & (place[:-1] % k == 0) & (place[1:] < ends[place[:-1]]))
    seeds = np.sort(place[near])
    for at in range(0, len(seeds), max(1, PAIRS // q)):
        some = seeds[at : at + max(1, PAIRS // q)]
        gram = grams[some]
        first = np.searchsorted(index, gram | (some + q).astype(np.uint64))
        last = np.searchsorted(index, gram | np.minimum(some + 2 * q, ends[some]).astype(np.uint64))
        counts = np.maximum(last - first, 0)
        starts = np.repeat(some, counts)
        others = place[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)]
        yield starts, others - starts


def _equal_for(words: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on."""
    done, step = 0, 32
    while done < most:
        step = min(step, most - done)
        differ = words[a + done : a + done + step] != words[b + done : b + done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, step * 2
    return most


def _equal_back(words: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words just before ``a`` equal those before ``b``."""
    done, step = 0, 32
    while done < most:
        step = min(step, most - done)
        differ = words[a - done - step : a - done][::-1] != words[b - done - step : b - done][::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, step * 2
    return most


def _divisors(q: int) -> list[int]:
    """q by each of its prime factors: any smaller period that divides q divides one of these."""
    out, rest, f = [], q, 2
    while f * f <= rest:
        if rest % f == 0:
            out.append(q // f)
            while rest % f == 0:
                rest //= f
        f += 1
    return out + [q // rest] * (rest > 1)


def find_runs(words: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in word numbers of several documents, which begin at ``starts``."""
    n = len(words)
    if not n:
        return []
    bounds = np.append(starts, n)
    sizes = np.diff(bounds)
    begins, ends = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    words = words.astype(np.uint64) + np.uint64(1)
    found: list[tuple[int, int, int]] = []
    # per word: the end and period of the known run that covers it and reaches furthest
    reach, period = np.zeros(n, np.int64), np.ones(n, np.int64)
    for q, m in classes(shortest, int(sizes.max())):
        covered: dict[int, int] = {}
        own = []
        for places, lags in _seeds(words, ends, q, m):
            new = ~((reach[places] >= places + lags) & (lags % period[places] == 0))
            for i, lag in zip(places[new].tolist(), lags[new].tolist()):
                if i < covered.get(lag, 0):
                    continue
                length = _equal_for(words, i, i + lag, int(ends[i]) - i - lag)
                if not length:
                    continue
                before = _equal_back(words, i, i + lag, i - int(begins[i]))
                covered[lag] = i + length
                if before + length >= max(lag, shortest - lag):
                    a = i - before
                    if all((words[a : a + lag - p] != words[a + p : a + lag]).any() for p in _divisors(lag)):
                        own.append((a, before + length + lag, lag))
        for a, length, lag in own:
            further = reach[a : a + length] < a + length
            reach[a : a + length][further] = a + length
            period[a : a + length][further] = lag
        found += own
    return sorted(found)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after another, and where each text's words begin."""
    texts = texts.cast(pa.large_string()).fill_null("")
    data = np.frombuffer(pa.concat_arrays([texts]).buffers()[2] or b"", np.uint8)
    cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = data[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    inner = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    edges = cuts[:-1][cuts[:-1] < len(data)]
    first[edges] = inner[edges]  # a text's first byte begins a word, whatever the text before ends with
    at = np.flatnonzero(first)
    inside = np.concatenate([[0], np.cumsum(inner)])
    offsets = np.append(inside[at], inside[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[inner].tobytes())])
    return words, np.searchsorted(at, cuts[:-1])


def _rows(texts: pa.Array, shortest: int) -> list[pa.Array]:
    """n_words, runs and collapsed text of some texts."""
    words, starts = _words(texts)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    bounds = np.append(starts, len(words))
    runs = find_runs(numbers, starts, shortest)
    kept = np.zeros(len(words) + 1, np.int64)
    for a, length, q in runs:
        kept[a + q] += 1
        kept[a + length] -= 1
    keep = np.cumsum(kept[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(keep)])[bounds]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep))), pa.scalar(" ", pa.large_string()))
    found = np.array(runs, np.int64).reshape(-1, 3)
    owner = np.searchsorted(bounds[1:], found[:, 0], side="right")
    fields = [pa.array(found[:, 0] - starts[owner] if len(found) else found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2])]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUN)))
    return [pa.array(np.diff(bounds)), lists, collapsed.cast(pa.string())]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period by start, then period), collapsed.

    ``collapsed`` has the words joined by one blank, without those that any run
    holds behind its first period. Words are stretches without ASCII white space.
    Null and blank texts have no words, no runs and an empty ``collapsed``.
    Repeated rows and ids each get a row of their own; ties cannot occur, as all
    runs are returned and no two have both start and period. A text of any length
    is searched whole in one task, in memory of some hundred bytes a word and
    time about in proportion to its words. An empty table gives no rows; other
    columns are ignored.
    """
    light_batches(docs.sparkSession)
    rows = only(docs, doc_id=doc_id, text=text)
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes) // GROUP_BYTES
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b > a:
                    yield pa.record_batch([ids.slice(a, b - a), *_rows(texts.slice(a, b - a), shortest)], names=["doc_id", "n_words", "runs", "collapsed"])
        hand_back()

    return rows.mapInArrow(run, f"doc_id {kind}, {RUNS}")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, one document in ten made periodic from some word on, by the hash of its id."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    rows = only(docs, doc_id="doc_id", text="text").withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    a, p = F.expr("(_h div 10) % size(_w)"), F.expr("1 + (size(_w) - (_h div 10) % size(_w)) div (3 + (_h div 10) % 8)")
    own = F.when(F.col("_h") % 10 == 0, words).alias("_w")
    rows = rows.select("doc_id", "text", "_h", own)
    rows = rows.select("doc_id", "text", "_w", F.when(F.size("_w") > 0, a).cast("int").alias("_a"), F.when(F.size("_w") > 0, p).cast("int").alias("_p"))
    again = F.transform(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: F.get("_w", F.when(i >= F.col("_a"), F.col("_a") + (i - F.col("_a")) % F.col("_p")).otherwise(i)))
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: the number of runs, the longest (ties: smallest start, then period) and digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("(1000 * _best.length) div -_best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
