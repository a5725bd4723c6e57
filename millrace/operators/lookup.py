"""The first of many names or patterns that occurs in a text.

Names go to shared storage in blocks of bounded size. A task builds one automaton
(a trie with failure links) for a block and reads each text once, so what is
shuffled, if anything, are hits. Patterns are tried only on texts that hold a
literal which every match of the pattern holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from re import _constants as sre, _parser as sre_parser

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import scratch_path

# characters of names or patterns in a block: its automaton takes some tens of bytes for each
BLOCK_CHARS = 2_000_000
# ignoring case, these match ASCII letters too
FOLD = {0x130: "i", 0x131: "i", 0x17F: "s", 0x212A: "k"}


def fold(text: str) -> str:
    """Lower case in which ASCII letters stand for all that match them when case is ignored."""
    return text.lower() if text.isascii() else text.translate(FOLD).lower()


def needed_literal(pattern: str) -> str:
    """The longest run of ASCII characters, in lower case, that every match of a pattern holds; may be empty."""

    def runs(parsed) -> Iterator[str]:
        run = ""
        for op, value in parsed:
            if op is sre.LITERAL and value < 128:
                run += chr(value)
                continue
            if op is sre.AT:  # an anchor or a word boundary takes no characters
                continue
            yield run
            run = ""
            if op is sre.SUBPATTERN:
                yield from runs(value[-1])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[0]:
                yield from runs(value[2])
            elif op is sre.ATOMIC_GROUP:
                yield from runs(value)
        yield run

    return max(runs(sre_parser.parse(pattern, re.I)), key=len).lower()


class Names:
    """Finds the first name of a list that occurs in a text."""

    def __init__(self, names: list[str]):
        self.automaton = ahocorasick.Automaton()
        for rank, name in enumerate(names):
            self.automaton.add_word(name, rank)
        self.automaton.make_automaton()

    def first(self, text: str) -> int | None:
        if not len(self.automaton):
            return None
        return min((rank for _, rank in self.automaton.iter(text)), default=None)


class Patterns:
    """Finds the first pattern of a list that occurs in a text, ignoring case."""

    def __init__(self, patterns: list[str]):
        self.tests = [re.compile(p, re.I) for p in patterns]
        by_literal: dict[str, list[int]] = {}
        for rank, p in enumerate(patterns):
            by_literal.setdefault(needed_literal(p), []).append(rank)
        self.always = by_literal.pop("", [])
        self.automaton = ahocorasick.Automaton()
        for literal, ranks in by_literal.items():
            self.automaton.add_word(literal, ranks)
        self.automaton.make_automaton()

    def first(self, text: str) -> int | None:
        possible = set(self.always)
        if len(self.automaton):
            for _, ranks in self.automaton.iter(fold(text)):
                possible.update(ranks)
        return next((rank for rank in sorted(possible) if self.tests[rank].search(text)), None)


_kept: dict[tuple, tuple] = {}


def _block(path: str, number: int, finder: type) -> tuple[object, pa.Table]:
    """A block's finder and rows in order, kept by the worker until it needs another."""
    if (path, number) not in _kept:
        _kept.clear()
        store, folder = pafs.FileSystem.from_uri(path)
        files = [f.path for f in store.get_file_info(pafs.FileSelector(f"{folder}/_block={number}", allow_not_found=True)) if f.path.endswith(".parquet")]
        table = pa.concat_tables([pq.ParquetFile(store.open_input_file(f)).read() for f in sorted(files)])
        table = table.take(pc.sort_indices(table, [("_ord", "ascending"), ("_what", "ascending")], null_placement="at_start"))
        _kept[path, number] = finder(table.column("_what").to_pylist()), table
    return _kept[path, number]


def first_occurring(df: DataFrame, key: str, text: Column, table: DataFrame, payload: Sequence[str], finder: type) -> DataFrame:
    """``df`` with the payload of the first row of ``table`` that occurs in ``text``, else nulls.

    ``table``: ``_what`` (a name or pattern, each once), ``_ord`` and the payload;
    rows come first by ``_ord`` (nulls first), then ``_what``. With one block the
    rows of ``df`` pass through the tasks and nothing is shuffled. Several blocks
    each give the texts' hits, and the first hits meet ``df`` by ``key``, which
    tells its rows apart.
    """
    spark = df.sparkSession
    table = table.where("_what is not null").select("_what", "_ord", *[F.col(f"`{p}`").alias(f"_p{i}") for i, p in enumerate(payload)])
    blocks = 1 + (table.agg(F.sum(F.length("_what"))).first()[0] or 0) // BLOCK_CHARS
    path = scratch_path(spark, "names")
    table.withColumn("_block", F.pmod(F.xxhash64("_what"), F.lit(blocks))).repartition(blocks, "_block").write.partitionBy("_block").parquet(path)
    there = {r[0] for r in spark.read.schema("_block long").parquet(path).select("_block").distinct().collect()}
    fields = [table.schema[f"_p{i}"] for i in range(len(payload))]
    types = [f"`{n}` {f.dataType.simpleString()}" for n, f in zip(payload, fields)]
    own = [f"_p{i}" for i in range(len(payload))]

    def found(number: int, texts: pa.Array) -> tuple[pa.Array, pa.Table]:
        look, rows = _block(path, number, finder)
        return pa.array([None if t is None else look.first(t) for t in texts.to_pylist()], pa.int64()), rows

    def passed(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits, rows = found(number, batch.column(batch.num_columns - 1))
                more = [rows.column(c).combine_chunks().take(hits) for c in own]
                yield pa.record_batch([*batch.columns[:-1], *more], names=[*batch.schema.names[:-1], *payload])

        return run

    def hit_rows(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits, rows = found(number, batch.column(1))
                some = pc.is_valid(hits)
                at = hits.filter(some)
                yield pa.record_batch([batch.column(0).filter(some), *(rows.column(c).combine_chunks().take(at) for c in ("_ord", "_what", *own))], names=["_k", "_ord", "_what", *own])

        return run

    if not there:
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(n) for n, f in zip(payload, fields)])
    if len(there) == 1:
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.withColumn("_text", text).mapInArrow(passed(there.pop()), f"{kept}, {', '.join(types)}")
    schema = ", ".join([f"_k {df.schema[key].dataType.simpleString()}", f"_ord {table.schema['_ord'].dataType.simpleString()}", "_what string", *(f"{c} {f.dataType.simpleString()}" for c, f in zip(own, fields))])
    texts, hits = df.select(F.col(f"`{key}`").alias("_k"), text.alias("_t")), None
    for number in sorted(there):
        part = texts.mapInArrow(hit_rows(number), schema)
        hits = part if hits is None else hits.union(part)
    first = hits.groupBy("_k").agg(F.min_by(F.struct(*own), F.struct("_ord", "_what")).alias("_hit"))
    out = df.join(first, F.col(f"`{key}`").eqNullSafe(F.col("_k")), "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_hit.{c}").alias(n) for c, n in zip(own, payload)])
