"""Reading files into tables. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.session import pinned, scratch_path
from millrace.sources.csv_records import NULL, csv_records, parsed

# Encodings whose line breaks and quotes are not single bytes.
WIDE = ("utf-16", "utf-32")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder; filters and columns are pushed into the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, encoding: str = "UTF-8", fallback: str | None = None, source_file: str | None = None
) -> DataFrame:
    """CSV with a header line, as RFC 4180 has it; columns are taken by position.

    Quoted fields may hold line breaks, doubled quotes and separators; blanks
    belong to fields; a quoted empty field is '' and an unquoted one null. Large
    files are split, whatever their records hold. A byte-order mark is dropped
    with the header. ``encoding`` is any that keeps the ASCII characters, or
    UTF-16 or UTF-32, of which a file is read by one task. Bytes that do not fit
    raise an error. With a ``fallback`` the encoding is chosen file by file: UTF-8
    where every line is valid UTF-8, else the fallback. ``source_file`` names a
    column for the path of each row's file.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if encoding.lower().replace("_", "-").startswith(WIDE):
        rows = spark.read.schema(schema).options(header=True, encoding=encoding, multiLine=True, escape='"', nullValue=NULL, emptyValue="").csv(path)
        return rows.withColumn(source_file, F.col("_metadata.file_path")) if source_file else rows
    records = csv_records(spark, path, encoding, fallback, keep_file=source_file is not None)
    fields = records.select(parsed("record", schema).alias("r"), *([F.col("file").alias(source_file)] if source_file else []))
    return fields.select("r.*", *([source_file] if source_file else []))


def read_many(spark: SparkSession, sources: Sequence[tuple[str, str | T.StructType]], encoding: str = "UTF-8") -> DataFrame:
    """CSV globs as one table, aligned by name, with the file each row came from."""
    parts = [read_csv(spark, glob, schema, encoding, source_file="source_file") for glob, schema in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def unzip_records(
    archives: DataFrame, content: str, suffix: str, columns: Sequence[str], encodings: Sequence[str] = ("utf-8-sig",), chunk: int = 20_000
) -> DataFrame:
    """CSV records of the members of ZIP archives whose name ends in ``suffix``, as text columns.

    Members are parsed as CSV, so quoted fields may hold line breaks, and fields
    are matched by the names in the header; a column a member lacks is null. The
    first of ``encodings`` that decodes a whole member is taken. ``content`` holds
    an archive, or the path of one, which has no size limit: then the members are
    listed first, from the directories at the archives' ends, and each is a task
    of its own that reads its part of the file. An archive held in a cell is read
    by one task. Records are handed on in chunks, so the unpacked text is never
    held whole.
    """
    names = list(columns)

    def encoding_of(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> str:
        for encoding in encodings:
            try:
                with archive.open(info) as raw, io.TextIOWrapper(raw, encoding=encoding) as text:
                    while text.read(1 << 20):
                        pass
                return encoding
            except UnicodeDecodeError:
                continue
        raise ValueError(f"{info.filename} is in none of the encodings {list(encodings)}")

    def opened(source):
        if isinstance(source, str):
            store, path = pafs.FileSystem.from_uri(source)
            return store.open_input_file(path)
        return io.BytesIO(source)

    def wanted(archive: zipfile.ZipFile) -> list[int]:
        return [k for k, info in enumerate(archive.infolist()) if info.filename.endswith(suffix)]

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch[content]:
                with opened(path) as file, zipfile.ZipFile(file) as archive:
                    places = wanted(archive)
                if places:
                    yield pd.DataFrame({content: [path] * len(places), "_place": places})

    def frames(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> Iterator[pd.DataFrame]:
        encoding = encoding_of(archive, info)
        with archive.open(info) as raw, io.TextIOWrapper(raw, encoding=encoding, newline="") as text:
            records = csv.reader(text)
            header = [h.strip() for h in next(records, [])]
            places = [header.index(n) if n in header else -1 for n in names]
            rows: list[list[str | None]] = []
            for record in records:
                if not record:
                    continue
                rows.append([info.filename, *(record[p] if 0 <= p < len(record) and record[p] != "" else None for p in places)])
                if len(rows) >= chunk:
                    yield pd.DataFrame(rows, columns=["member", *names])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["member", *names])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(1 << 30)
        for batch in batches:
            places = batch["_place"] if "_place" in batch else [None] * len(batch)
            for source, place in zip(batch[content], places):
                with opened(source) as file, zipfile.ZipFile(file) as archive:
                    for k in wanted(archive) if place is None else [place]:
                        yield from frames(archive, archive.infolist()[k])

    tasks = archives.select(content)
    if isinstance(tasks.schema[0].dataType, T.StringType):
        tasks = pinned(tasks.mapInPandas(listed, f"`{content}` string, _place int"))
        tasks = tasks.repartition(max(tasks.count(), 1))
    return tasks.mapInPandas(read, "member string, " + ", ".join(f"`{n}` string" for n in names))


def typed(records: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Text columns cast to a schema; text that does not fit becomes null."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return records.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])


def read_zipped_csv(spark: SparkSession, path: str, suffix: str, schema: str, encodings: Sequence[str] = ("utf-8-sig",)) -> DataFrame:
    """CSV members of one or many ZIP archives as one table.

    Only paths and places of members are listed here; archives are opened by the
    tasks that read them, so they may be larger than a binary cell.
    """
    paths = spark.read.format("binaryFile").load(path).select("path")
    return typed(unzip_records(paths, "path", suffix, T.StructType.fromDDL(schema).names, encodings), schema)


def load_dimension(df: DataFrame, marker_column: str, marker: str, keys: Sequence[str]) -> DataFrame:
    """Drop the echoed header row and turn the key columns into strings."""
    kept = df.where(~F.col(marker_column).eqNullSafe(F.lit(marker)))
    return kept.withColumns({k: F.col(k).cast("string") for k in keys})


def flatten_json(
    df: DataFrame, payload: str, schema: str, fields: dict[str, Column], explode: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Nested JSON text as flat rows.

    ``fields`` are expressions over ``j``, the parsed record, and ``item``, the
    element of the array at ``explode`` (a path such as ``j.results``). Records
    with an empty array, or that fail to parse, are kept with nulls.
    """
    out = df.select(*keep, F.from_json(payload, schema).alias("j"))
    if explode:
        out = out.select(*keep, "j", F.explode_outer(explode).alias("item"))
    return out.select(*keep, *[c.alias(name) for name, c in fields.items()])


FEATURE = "type string, properties map<string,string>, geometry struct<type:string, coordinates:string>"
# A bracket, or a string of JSON; the group is empty where the string goes on behind the bytes at hand.
_MARKS = re.compile(rb'[{}\[\]]|"(?:[^"\\]++|\\.)*+("?)', re.DOTALL)

_BREAKS = bytes.maketrans(b"\r\n", b"  ")


def _elements(read: Callable[[int], bytes], name: bytes, chunk: int) -> Iterator[bytes]:
    """The objects in the array ``name`` of each JSON document, as they come.

    Documents stand one after another or in one array. Not more than one element
    and the last chunk read are held.
    """
    held, at, start = b"", 0, None
    stack: list[bytes] = []
    key, inside = b"", 0  # the last string, and the depth of the array while in it
    while more := read(max(chunk, len(held))):
        keep = at if start is None else start
        held, at, start = held[keep:] + more, at - keep, None if start is None else 0
        while mark := _MARKS.search(held, at):
            token = mark.group()
            if token[:1] == b'"':
                if not mark.group(1):
                    break
                key = token
            elif token in b"{[":
                if token == b"[" and not inside and key == name and stack in ([b"{"], [b"[", b"{"]):
                    inside = len(stack) + 1
                elif token == b"{" and inside and len(stack) == inside:
                    start = mark.start()
                stack.append(token)
                key = b""
            else:
                if not stack:
                    raise ValueError("a bracket is closed that was not opened")
                stack.pop()
                if start is not None and len(stack) == inside:
                    yield held[start : mark.end()]
                    start = None
                elif len(stack) < inside:
                    inside = 0
            at = mark.end()
        else:
            at = len(held)
            continue
        at = mark.start()
    if stack:
        raise ValueError("the document ends before its brackets are closed")


def feature_texts(paths: DataFrame, path: str = "path", chunk: int = 1 << 20) -> DataFrame:
    """Every feature of GeoJSON files as one line of JSON, in the column ``feature``.

    A task reads a file from front to end and hands features on in batches, so
    files may be far larger than its memory; a single feature is held whole.
    Files are UTF-8; elements of ``features`` that are no objects are left out.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, name = pafs.FileSystem.from_uri(uri)
                with store.open_input_stream(name) as file:
                    texts, size = [], 0
                    for text in _elements(file.read, b'"features"', chunk):
                        # outside of strings a line break is a blank, and inside there are none
                        texts.append(text.translate(_BREAKS).decode())
                        size += len(text)
                        if size >= chunk:
                            yield pa.RecordBatch.from_pydict({"feature": texts})
                            texts, size = [], 0
                    if texts:
                        yield pa.RecordBatch.from_pydict({"feature": texts})

    return paths.select(path).mapInArrow(read, "feature string")


def read_features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Properties and geometry of every feature of GeoJSON files, one row each.

    Files hold documents of any size, each read by one task feature by feature;
    with ``multi_line=False`` a document is one line, and a file is split between tasks.
    Nested values are their JSON as the file has it, line breaks as blanks.
    """
    if multi_line:
        # as lines in the shared folder, features are parsed by many tasks
        lines = scratch_path(spark, "features")
        feature_texts(spark.read.format("binaryFile").load(path).select("path")).write.text(lines)
        features = spark.read.schema(FEATURE).json(lines).select(F.struct("properties", "geometry").alias("f"))
    else:
        doc = spark.read.schema(f"type string, features array<struct<{FEATURE}>>").json(path)
        features = doc.select(F.explode("features").alias("f"))
    return features.select(
        F.col("f.properties").alias("properties"),
        F.col("f.geometry.type").alias("geometry_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )
