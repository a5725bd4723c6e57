"""Records of CSV files that are split between tasks, quoted line breaks included.

A line begins a record unless an odd number of quote characters precede it in
its file: a doubled quote counts twice and so changes nothing. One pass counts
the quotes of every byte range (block) a scan cuts files into; the parities of
the blocks before it tell each block whether it begins inside quotes. A second
pass over the same blocks joins lines to records. Only records that cross the
border of two blocks are put together from their parts, so a file of any size is
read by as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace.session import scratch_path

# so many unusual blocks are handed to every task; beyond, lines are shuffled to them
BROADCAST_BLOCKS = 100_000
ODD, OTHER = 1, 2  # a block begins inside quotes; its file is not UTF-8
RECORDS = "file string, block long, place long, part boolean, opens boolean, record string"


def _lines(spark: SparkSession, path: str | list[str], keep_file: bool) -> DataFrame:
    """Lines of the files as they are, in the order of the scan."""
    raw = spark.read.option("lineSep", "\n").text(path)
    name = F.col("_metadata.file_path")
    return raw.select("value", F.xxhash64(name).alias("id"), F.col("_metadata.file_block_start").alias("block"), (name if keep_file else F.lit(None).cast("string")).alias("file"))


def _blocks(lines: DataFrame) -> DataFrame:
    """A row for each block: how its lines are to be read."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    parts = lines.groupBy("id", "block").agg((F.sum(quotes) % 2).alias("odd"), F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    before = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("id")
    behind = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    kind = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) * ODD + F.when(F.bool_and("valid").over(file), 0).otherwise(OTHER)
    return parts.select("id", "block", kind.cast("int").alias("kind"), (F.sum("odd").over(behind) % 2 == 1).alias("open"))


def _joined(lines: DataFrame, blocks: DataFrame, how: str) -> DataFrame:
    """Lines and their block's row, still in order."""
    if blocks.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS:
        return lines.join(F.broadcast(blocks), ["id", "block"], how)
    numbered = lines.withColumn("n", F.monotonically_increasing_id()).join(blocks, ["id", "block"], how)
    return numbered.repartition("id", "block").sortWithinPartitions("id", "block", "n").drop("n")


def _text(raw: pa.Array, encoding: str) -> pa.Array:
    if encoding == "utf-8":
        return raw.cast(pa.string())  # raises on bytes that are not UTF-8
    return pa.array([x.decode(encoding) for x in raw.to_pylist()], pa.string())


def _cut(lines: DataFrame, encoding: str, other: str) -> DataFrame:
    """Records, and parts of records that cross the borders of a block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, started, place, inside, code = None, [], False, 0, False, encoding

        def rows(texts: pa.Array, parts: list[bool], opens: list[bool]) -> pa.RecordBatch:
            nonlocal place
            n = len(texts)
            out = pa.record_batch([
                pa.array([key[2]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(np.arange(place, place + n)),
                pa.array(parts, pa.bool_()), pa.array(opens, pa.bool_()), texts,
            ], names=["file", "block", "place", "part", "opens", "record"])
            place += n
            return out

        def rest() -> Iterator[pa.RecordBatch]:
            """What the block ends with; a part, unless it is a whole record."""
            if held:
                whole = started and not inside
                yield rows(_text(pa.array([b"\n".join(held)], pa.binary()), code), [not whole], [started])

        for batch in batches:
            values, ids, blocks, files, kinds = (batch.column(k) for k in range(5))
            blocks, ids, names = blocks.to_numpy(), ids.to_numpy(), files
            values = values.fill_null(b"")
            quotes = pc.count_substring(values, b'"').to_numpy(zero_copy_only=False)
            borders = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(ids) != 0)) + 1
            for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(blocks)]):
                if a == b:
                    continue
                now = (int(ids[a]), int(blocks[a]), names[a].as_py())
                if now != key:
                    yield from rest()
                    kind = kinds[a].as_py() or 0
                    key, held, started, place, inside, code = now, [], False, 0, bool(kind & ODD), other if kind & OTHER else encoding
                upto = (np.cumsum(quotes[a:b]) + inside) % 2 == 1
                first = ~np.concatenate([[inside], upto[:-1]])  # lines that begin a record
                at = np.flatnonzero(first) + a
                own = values.slice(a, b - a)
                if not len(at):
                    held += own.to_pylist()
                    inside = bool(upto[-1])
                    continue
                # what was held ends before the first record here
                held += values.slice(a, at[0] - a).to_pylist()
                if held:
                    yield rows(_text(pa.array([b"\n".join(held)], pa.binary()), code), [not started], [started])
                if (n := len(at) - 1) and (np.diff(at) == 1).all():
                    yield rows(_text(values.slice(at[0], n), code), [False] * n, [True] * n)
                elif n:
                    several = pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), values), pa.scalar(b"\n"))
                    yield rows(_text(several, code), [False] * n, [True] * n)
                # the last record may go on in the next batch
                held, started, inside = values.slice(at[-1], b - at[-1]).to_pylist(), True, bool(upto[-1])
        yield from rest()

    return lines.select(F.col("value").cast("binary").alias("value"), "id", "block", "file", "kind").mapInArrow(cut, RECORDS)


def csv_records(spark: SparkSession, path: str | list[str], encoding: str = "utf-8", fallback: str | None = None, keep_file: bool = False) -> DataFrame:
    """(file, record) of all records but each file's first, the header.

    Line breaks within quotes belong to the record, those between records are
    ``\\n`` or ``\\r\\n``; blank lines are no records. ``encoding`` keeps the ASCII
    characters; bytes that do not fit it raise an error, unless a ``fallback`` is
    given: it is taken for files with a line that is not valid UTF-8. Quotes that
    stay open reach to the end of their file.
    """
    lines = _lines(spark, path, keep_file)
    where = scratch_path(spark, "blocks")
    _blocks(lines).write.parquet(where)
    blocks = spark.read.parquet(where)
    unusual = blocks.where("kind > 0" if fallback else f"(kind & {ODD}) > 0").select("id", "block", "kind")
    code = encoding.lower().replace("_", "-")
    records = _cut(_joined(lines, unusual, "left"), code, fallback or code)
    whole = records.where("not part")
    if not blocks.where("open").isEmpty():
        # blocks that end, or begin, inside a record hold its parts
        edges = blocks.where(f"open or (kind & {ODD}) > 0").select("id", "block", "kind")
        parts = _cut(_joined(lines.withColumn("file", F.coalesce("file", F.col("id").cast("string"))), edges, "inner"), code, fallback or code)
        parts = parts.where("part")
        order = Window.partitionBy("file").orderBy("block", "place")
        numbered = parts.withColumn("n", F.sum(F.col("opens").cast("int")).over(order))
        pieces = F.array_sort(F.collect_list(F.struct("block", "place", "record")))  # the parts of one record
        whole_again = numbered.groupBy("file", "n").agg(pieces.alias("p"))
        first = F.col("p")[0]
        whole = whole.select("file", "block", "place", "record").union(
            whole_again.select(F.when(F.lit(keep_file), F.col("file")).alias("file"), first["block"].alias("block"), first["place"].alias("place"), F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
        )
    record = F.regexp_replace("record", r"\r\z", "")
    return whole.where("block > 0 or place > 0").select("file", record.alias("record")).where(F.trim(F.col("record")) != "")


NULL = "\ufdd0"  # no character of any text: what stands for an empty field without quotes


def parsed(record: str, schema: T.StructType) -> Column:
    """The fields of a record by the rules of RFC 4180; a quoted empty field is '', an unquoted one null."""
    options = {"escape": '"', "quote": '"', "nullValue": NULL, "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return F.from_csv(record, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), options)
