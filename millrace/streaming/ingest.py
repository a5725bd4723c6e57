"""Incremental ingestion of landed files with Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.sources.writers import one_per_key


def landed(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_dedup(sdf: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first record of each key; copies arriving within the delay are dropped.

    State is let go once the watermark passes it, so it does not grow for ever.
    """
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def stream_daily_counts(sdf: DataFrame, ts: str, key: str, delay: str) -> DataFrame:
    """Rows per day and key; rows later than the watermark are dropped."""
    days = sdf.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), key).agg(F.count(F.lit(1)).alias("n"))
    return days.select(F.col("window.start").cast("date").alias("day"), key, "n")


def drain(sdf: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything landed so far to a Parquet table and stop.

    The file sink lists what each batch has committed, so a repeated batch adds
    nothing twice and a failed one leaves the table as it was.
    """
    sdf.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()


def stream_upsert(sdf: DataFrame, keys: Sequence[str], version: Sequence[Column], path: str, checkpoint: str) -> None:
    """Land the latest record per key of every batch, then stop.

    A batch writes only its own folder, named after the checkpoint and its
    number: a repeated batch replaces that same folder, and a stream that lost
    its checkpoint lands under new names and overwrites nothing. ``landed`` says
    when a row came. :func:`current` reads the merged state; :func:`compact`
    folds the folders of the same table together while the stream goes on.
    """

    def land(batch: DataFrame, n: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        newest = one_per_key(batch, keys, [v.desc() for v in version])
        newest.withColumn("landed", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/batch={run}-{n}")

    sdf.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _merged(rows: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    return one_per_key(rows, keys, [*[v.desc() for v in version], F.col("landed").desc()])


def current(spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """The latest record per key over all landed batches; of equal versions the one landed last wins."""
    return _merged(spark.read.parquet(path), keys, version).drop("batch", "landed")


def compact(spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[Column]) -> None:
    """Fold the batches landed so far into one folder of the same table.

    The merged folder is complete before the folders it replaces go, and rows
    that are in both meanwhile are merged by every reader, so neither a failure
    nor a stream that lands more batches meanwhile changes the state.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in store.listStatus(root) if f.isDirectory() and f.getPath().getName().startswith("batch=")]
    rows = spark.read.option("basePath", path).parquet(*[p.toString() for p in old])
    _merged(rows, keys, version).drop("batch").write.parquet(f"{path}/batch=merged-{uuid.uuid4().hex}")
    for folder in old:
        store.delete(folder, True)
