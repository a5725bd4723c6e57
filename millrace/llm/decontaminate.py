"""Benchmark passages in training text, found by an FM-index per shard.

A shard is a slice of a task's documents with at most ``SHARD`` kept symbols or
so. A word that occurs in no test phrase separates runs; a run shorter than the
shortest phrase cannot hold one and is left out of the index. Both steps keep
every occurrence. The phrases are found by backward search, located through
sampled suffix positions, and their spans merged per document.

Phrases go to the tasks in blocks of ``BLOCK_WORDS`` words at most, so what a
task holds has a fixed bound; more blocks mean more passes over the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.fm_index import FMIndex
from millrace.llm.shared import hand_back, light_batches, only, written

WINDOW = 10
BLOCK_WORDS = 400_000
SHARD = 500_000
SHARD_WORDS = 4_000_000
# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_SPACE = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(TO_SPACE).split()


class Phrases:
    """The distinct windows of a block of test items."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        found: dict[tuple, set] = {}
        for item, words in items:
            size = min(window, len(words))
            for k in range(len(words) - size + 1 if size else 0):
                found.setdefault(tuple(words[k : k + size]), set()).add(item)
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for p in found for w in p}), 1)}
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.patterns = np.zeros((len(found), window), np.int32)
        for row, p in enumerate(found):
            self.patterns[row, : len(p)] = [self.vocabulary[w] for w in p]
        self.items = [sorted(i) for i in found.values()]
        self.shortest = int(self.lengths.min(initial=window))


def phrase_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[list]:
    """Items in blocks of bounded size; a longer item is cut with overlap, so no window is lost."""
    block, size = [], 0
    for row in only(benchmark, item_id=item_id, text=text).where("text is not null").toLocalIterator():
        words = words_of(row.text)
        for at in range(0, max(1, len(words) - window + 1), block_words):
            part = words[at : at + block_words + window - 1]
            if part:
                block.append((row.item_id, part))
                size += len(part)
            if size >= block_words:
                yield block
                block, size = [], 0
    if block:
        yield block


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the spans of each document, ordered."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # ends made to grow over documents, so one running maximum serves all of them
    shift = doc * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + shift)
    first = np.ones(len(doc), bool)
    first[1:] = start[1:] + shift[1:] > reach[:-1]
    last = np.concatenate([np.flatnonzero(first)[1:] - 1, [len(doc) - 1]]) if len(doc) else np.zeros(0, np.int64)
    return doc[first], start[first], reach[last] - shift[last]


def _search(shard: list[np.ndarray], phrases: Phrases) -> tuple[dict[int, list], dict[int, set]]:
    """Merged spans (word positions) and items by document of the shard."""
    lengths = np.array([len(s) for s in shard], np.int64)
    flat = np.concatenate([np.concatenate([s, [0]]) for s in shard]) if shard else np.zeros(0, np.int32)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    # runs of known words that can hold the shortest phrase, with the separator behind them
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (flat > 0).astype(np.int8), [0]])))
    begin, stop = edge[::2], edge[1::2]
    long = stop - begin >= phrases.shortest
    begin, stop = begin[long], stop[long]
    size = stop - begin + 1
    places = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    if not len(places) or not len(phrases.lengths):
        return {}, {}
    index = FMIndex(flat[places])
    low, high = index.search(phrases.patterns, phrases.lengths)
    count = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(count)), count)
    rows = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    at = places[index.locate(rows)]
    doc = np.searchsorted(firsts, at, "right") - 1
    start = at - firsts[doc]
    spans: dict[int, list] = {}
    for d, a, b in zip(*(x.tolist() for x in _merged(doc, start, start + phrases.lengths[which]))):
        spans.setdefault(d, []).append((a, b))
    items: dict[int, set] = {}
    for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
        items.setdefault(d, set()).update(phrases.items[w])
    return spans, items


def _join_spans(old: list, new: list) -> list:
    out: list[tuple[int, int]] = []
    for a, b in sorted([*old, *new]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(text: str, spans: list) -> str:
    """The text without the words of the spans; each gap becomes a line break."""
    raw = text.encode()
    places = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : places[a][0]].rstrip())
        at = places[b - 1][1]
    return b"\n".join([*out, raw[at:].lstrip()]).decode()


def _marked(docs: DataFrame, phrases: Phrases, keep_text: bool) -> DataFrame:
    """Adds or widens ``spans`` and ``items`` of every row for one block of phrases."""
    schema = "doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<long>" + ", text string" * keep_text
    if "rest" in docs.columns:
        schema += f", rest {docs.schema['rest'].dataType.simpleString()}"
    span_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, none = phrases.vocabulary.get, repeat(0)

        def flush(rows: list, shard: list, kinds: pa.Schema) -> pa.RecordBatch:
            spans, items = _search(shard, phrases)
            out = {
                "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                "n_words": pa.array([len(s) for s in shard], pa.int64()),
                "spans": pa.array([[{"a": a, "b": b} for a, b in _join_spans([(s["a"], s["b"]) for s in r.get("spans") or []], spans.get(n, []))] for n, r in enumerate(rows)], span_type),
                "items": pa.array([sorted(items.get(n, set()).union(r.get("items") or [])) for n, r in enumerate(rows)], pa.list_(pa.int64())),
            }
            if keep_text:
                out["text"] = pa.array([r["text"] for r in rows], pa.string())
            if "rest" in kinds.names:
                out["rest"] = pa.array([r["rest"] for r in rows], kinds.field("rest").type)
            return pa.RecordBatch.from_pydict(out)

        rows, shard, kept, size = [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                for row in batch.slice(at, 100).to_pylist():
                    words = words_of(row["text"])
                    symbols = np.fromiter(map(known, words, none), np.int32, len(words))
                    if not keep_text:
                        del row["text"]
                    rows.append(row)
                    shard.append(symbols)
                    kept, size = kept + int(np.count_nonzero(symbols)), size + len(words)
                    if kept >= SHARD or size >= SHARD_WORDS:
                        yield flush(rows, shard, batch.schema)
                        rows, shard, kept, size = [], [], 0, 0
        if rows:
            yield flush(rows, shard, batch.schema)
        hand_back()

    return docs.mapInArrow(mark, schema)


def marked_documents(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, keep_text: bool = False, carry: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans (word positions, merged), items, and the text if asked for.

    A window is ``window`` consecutive words of an item; a shorter item is one
    window, an item without words none. Null texts have no words; a text of any
    length is searched whole; spans that overlap or touch are one, and items with
    equal windows are all named. Null ids are carried along; repeated rows give
    repeated results; an empty table gives none; an empty benchmark leaves every
    document clean. Only the named columns are read; those of ``carry`` come back
    in the struct ``rest``.
    """
    light_batches(docs.sparkSession)
    rest = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("rest")] if carry else []
    out = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), *rest)
    blocks = phrase_blocks(benchmark, item_id, item_text, window, block_words)
    block = next(blocks, [])
    while True:
        later = next(blocks, None)
        out = _marked(out, Phrases(block, window), keep_text or later is not None)
        if later is None:
            return out
        out, block = written(out, "marked"), later


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated; see ``marked_documents``."""
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return marked_documents(docs, benchmark, **options).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def cleaned_texts(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_hit and the text without the words of the found spans; ``rest`` as in ``marked_documents``."""
    marked = marked_documents(docs, benchmark, keep_text=True, **options)
    rest = f", rest {marked.schema['rest'].dataType.simpleString()}" if "rest" in marked.columns else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pylist()
                texts = [_without(r["text"], [(s["a"], s["b"]) for s in r["spans"]]) if r["spans"] else r["text"] for r in rows]
                hits = [sum(s["b"] - s["a"] for s in r["spans"]) for r in rows]
                out = {"doc_id": batch.column("doc_id").slice(at, 500), "n_hit": pa.array(hits, pa.int64()), "text": pa.array(texts, pa.string())}
                if rest:
                    out["rest"] = batch.column("rest").slice(at, 500)
                yield pa.RecordBatch.from_pydict(out)

    return marked.mapInArrow(cut, f"doc_id long, n_hit long, text string{rest}")
