"""Writing tables and merging batches into them."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F


MARK = "\ufeff"  # fixed value: the byte-order mark by which spreadsheets know UTF-8


def write_csv(df: DataFrame, path: str, mark: bool = False, one_file: bool = False) -> None:
    """A folder of CSV files with header lines, with a byte-order mark in front if asked.

    Quotes are doubled, blanks kept, '' is written in quotes and null as nothing,
    so ``read_csv`` gives back what was written. Only a row of one null column
    cannot be told from a blank line.

    With ``one_file`` the folder holds a single file. On a mounted file system
    (``file:``) all tasks write it, each its own range of bytes. Other stores have
    one writer for a file, so there one task writes all rows.
    """
    out = df.withColumnRenamed(df.columns[0], MARK + df.columns[0]) if mark else df
    rules = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""'}

    def write(rows: DataFrame, to: str, header: bool = True) -> None:
        rows.write.mode("overwrite").options(header=header, **rules).csv(to)

    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    at = hadoop(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not one_file or store.getUri().getScheme() != "file":
        return write(out.coalesce(1) if one_file else out, path)
    own = f"{path}-parts-{uuid.uuid4().hex}"
    write(out.where(F.lit(False)), f"{own}/header")
    write(out, f"{own}/rows", header=False)
    parts, end = [], 0
    for folder in ("header", "rows"):
        files = {f.getPath().toUri().getPath(): f.getLen() for f in store.listStatus(hadoop(f"{own}/{folder}"))}
        for name in sorted(f for f in files if f.endswith(".csv")):
            parts.append((name, end))
            end += files[name]
    store.mkdirs(hadoop(f"{own}/whole"))
    _put_together(spark, parts, hadoop(f"{own}/whole/part-00000.csv").toUri().getPath())
    store.delete(at, True)
    if not store.rename(hadoop(f"{own}/whole"), at):
        raise OSError(f"cannot put the file at {path}")
    store.delete(hadoop(own), True)


def _put_together(spark: SparkSession, parts: list[tuple[str, int]], whole: str) -> None:
    """Copy every file to its place in ``whole``, a task for each; a task that runs again writes the same bytes."""

    def put(part: tuple[str, int]) -> None:
        name, at = part
        with open(name, "rb") as source, open(os.open(whole, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as target:
            target.seek(at)
            shutil.copyfileobj(source, target, 1 << 20)

    spark.sparkContext.parallelize(parts, len(parts)).foreach(put)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table, optionally split by columns so readers can prune.

    The new table is written beside the old one and takes its place when it is
    whole, so a write that fails leaves the old table as it was.
    """
    spark, own = df.sparkSession, uuid.uuid4().hex
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}-new-{own}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    new, at, old = hadoop(f"{path}-new-{own}"), hadoop(path), hadoop(f"{path}-old-{own}")
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    replaces = store.exists(at)
    if replaces and not store.rename(at, old):
        raise OSError(f"cannot move {path}")
    if not store.rename(new, at):
        if replaces:
            store.rename(old, at)
        raise OSError(f"cannot put the new table at {path}")
    if replaces:
        store.delete(old, True)


def publish_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0, path: str | None = None
) -> None:
    """Replace a table of the session's catalog, optionally split by columns or into sorted buckets.

    Tables with as many buckets by their join keys meet without a shuffle. The
    new table is written under a name of its own, below ``path`` if given, and
    then takes the old one's, so a write that fails leaves the old table.
    """
    own = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", f"{path}/{own}")
    writer.saveAsTable(own)
    df.sparkSession.sql(f"drop table if exists {name}")
    df.sparkSession.sql(f"alter table {own} rename to {name}")


def to_json_records(df: DataFrame, out: str = "record") -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(out))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter is applied before the shuffle as well (Catalyst plants a
    partial group limit), so each task sends one row per key however many
    copies a key has.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """Old and new rows merged, the highest version of each key winning."""
    return one_per_key(old.unionByName(new, allowMissingColumns=True), keys, [v.desc() for v in version])


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows of ``new`` whose key is not in ``old``, the first of each key winning.

    Append the result to ``old``, or let :func:`append_new` do both.
    """
    return one_per_key(new, keys, order).join(old.select(*keys).distinct(), list(keys), "left_anti")


def append_new(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> int:
    """Append the rows of ``new`` with unknown keys to a Parquet table; returns how many were added."""
    old = spark.read.schema(new.schema).parquet(path)
    count = Observation()
    insert_new(old, new, keys, order).observe(count, F.count(F.lit(1)).alias("added")).write.mode("append").parquet(path)
    return count.get["added"]
