"""Repeated multi-line passages, removed in content-defined chunks.

Lines with any word are hashed two by two: a rolling hash over a line and the one
before it. A boundary lies where that hash is found nowhere else in the corpus,
so boundaries depend on two lines each, an inserted line moves none further on,
and the chunks between them are the longest stretches of lines that repeat. A
window of two lines is removed where the same bytes occur before; what is removed
of a document are the chunks made of such windows.

Only digests of windows are counted over the corpus. The bytes of those that
repeat are compared: the least and the greatest of a digest's bytes are the same
if all are, which needs one row for each digest and task, however often a footer
occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.shared import discard, light_batches, only, written

# a window's lines: two with words, and any blank ones between them
KEY = ["doc_id", "h"]
ROW = "doc_id long, h long"
ROW_TYPES = [("doc_id", pa.int64()), ("h", pa.int64())]


def windows(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, last line) of each pair of lines with words that follow each other, blank lines aside."""
    worded = [i for i, x in enumerate(lines) if x.split()]
    return list(zip(worded, worded[1:]))


def _body(lines: list[bytes], a: int, b: int) -> bytes:
    return b"\n".join(lines[a : b + 1])


def _per_row(docs: DataFrame, make, schema: str, types: list) -> DataFrame:
    """``make`` gives rows for each row of ``docs``, a few hundred rows at a time."""
    types = pa.schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = [r for x in batch.slice(at, 200).to_pylist() for r in make(x)]
                columns = zip(*rows) if rows else [()] * len(types)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return docs.mapInArrow(run, schema)


def _digests(docs: DataFrame) -> DataFrame:
    """Line and digest of every window."""

    def make(x: dict):
        import xxhash

        lines = x["text"].encode().split(b"\n")
        return [(x["doc_id"], x["h"], a, xxhash.xxh3_128_digest(_body(lines, a, b))) for a, b in windows(lines)]

    return _per_row(docs, make, f"{ROW}, line int, digest binary", [*ROW_TYPES, ("line", pa.int32()), ("digest", pa.binary())])


def _bodies(docs: DataFrame) -> DataFrame:
    """Line, digest and bytes of the windows that begin at ``asked`` lines."""

    def make(x: dict):
        import xxhash

        lines, asked = x["text"].encode().split(b"\n"), set(x["asked"])
        bodies = [(a, _body(lines, a, b)) for a, b in windows(lines) if a in asked]
        return [(x["doc_id"], x["h"], a, xxhash.xxh3_128_digest(body), body) for a, body in bodies]

    return _per_row(docs, make, f"{ROW}, line int, digest binary, body binary", [*ROW_TYPES, ("line", pa.int32()), ("digest", pa.binary()), ("body", pa.binary())])


RESULT = "doc_id long, n_lines long, n_removed_chunks long, n_removed_lines long, text string"


def _without(docs: DataFrame) -> DataFrame:
    """Rows without the windows that begin at ``gone`` lines."""

    def make(x: dict):
        if x["text"] is None:
            return [(x["doc_id"], 0, 0, 0, None)]
        lines, gone, out = x["text"].split("\n"), set(x["gone"] or ()), set()
        if gone:
            for a, b in windows([v.encode() for v in lines]):
                if a in gone:
                    out.update(range(a, b + 1))
        chunks = sum(i - 1 not in out for i in out)
        text = "\n".join(v for i, v in enumerate(lines) if i not in out) if out else x["text"]
        return [(x["doc_id"], len(lines), chunks, len(out), text)]

    names = ["doc_id", "n_lines", "n_removed_chunks", "n_removed_lines"]
    return _per_row(docs, make, RESULT, [*((n, pa.int64()) for n in names), ("text", pa.string())])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_removed_chunks, n_removed_lines, text without them.

    Removed are stretches of at least two lines with words of which every two
    neighbours occur together before, in another document or earlier in the same
    one; documents come by id, and rows of one id by a hash of their texts. Blank
    lines within a stretch go with it; lines of blanks alone repeat nothing. Null
    texts stay null and have no lines, empty ones have one; rows without a doc_id
    are left as they are; rows equal in id and text count as one document, so
    both keep it; a text of any length is read whole in one task; an empty table
    gives none; other columns are ignored.
    """
    light_batches(docs.sparkSession)
    docs = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("h", F.xxhash64("text"))
    usable = docs.where("doc_id is not null and text is not null")
    found = written(_digests(usable).distinct(), "windows")
    place = F.struct("doc_id", "h", "line")
    # the first place of each digest that has several
    firsts = found.groupBy("digest").agg(F.min(place).alias("keep"), F.max(place).alias("last")).where("keep < last").select("digest", "keep")
    repeated = written(found.join(firsts, "digest"), "repeated")
    discard(docs.sparkSession, found)
    asked = repeated.groupBy(*KEY).agg(F.collect_set("line").alias("asked"))  # lines of one document
    bodies = _bodies(usable.join(asked, KEY).select(*KEY, "text", "asked"))
    clash = written(bodies.groupBy("digest").agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a <> b").select("digest"), "clash")
    gone = repeated.where(place > F.col("keep")).select(*KEY, "line", "digest")
    if not clash.isEmpty():
        # equal digests of other bytes: told apart by the bytes themselves
        told = written(bodies.join(clash, "digest", "left_semi").distinct(), "told")
        keep = told.groupBy("body").agg(F.min(place).alias("keep"))
        gone = gone.join(clash, "digest", "left_anti").unionByName(told.join(keep, "body").where(place > F.col("keep")).select(*KEY, "line", "digest"))
    gone = gone.groupBy(*KEY).agg(F.collect_set("line").alias("gone"))
    return _without(docs.join(gone, KEY, "left").select("doc_id", "text", "gone"))
