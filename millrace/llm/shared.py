"""Small helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import scratch_path

# ASCII white space, as in the word pattern [^\x20\x09-\x0D]+.
SPACES = " \t\n\x0b\x0c\r"


BATCH_ROWS = 500


def light_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of ``BATCH_ROWS`` rows at most, for the rest of the session.

    Batches of the default 10,000 documents take a hundred megabytes and more on
    either side of every task. A smaller setting of the session stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing needs any more."""
    jvm = spark._jvm
    for df in tables:
        for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession, *tables: DataFrame) -> None:
    """:func:`discard`, and have the driver collect what finished plans have left.

    Spark frees their shuffles and broadcasts only when the driver collects, and
    the driver's heap, once grown, shrinks by a full collection only. Operators of
    many plans would grow it to its limit, however little of it is in use.
    """
    discard(spark, *tables)
    gc.collect()  # plans that only Python still refers to
    spark._jvm.System.gc()


def once_per_worker(key: tuple, make: Callable):
    """``make()``, kept for later tasks of the same Python worker until another thing is wanted."""
    kept = sys.__dict__.setdefault("_millrace_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def hand_back() -> None:
    """Return freed memory to the system at the end of a task: workers stay while later stages run."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU C library
        pass


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; all others are left out."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


FILTER_BITS = 1 << 23


def _met_bits(df: DataFrame, column: str, ids: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``df`` beside the broadcast bitmap of the ids' hashes, and the bit of each row."""

    def place(c: str):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(FILTER_BITS)).cast("int")

    (name,) = ids.columns
    bits = ids.select(place(name).alias("p")).groupBy(F.shiftright("p", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, p & 63)")).alias("_bits"))
    marked = df.withColumn("_place", place(column)).withColumn("_word", F.shiftright("_place", 6))
    return marked.join(F.broadcast(bits), "_word", how), F.expr("(shiftrightunsigned(_bits, _place & 63) & 1) = 1")


def roughly_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``ids``, before an exact join shuffles them.

    A bitmap of the ids' hashes is broadcast: at most ``FILTER_BITS`` / 64 rows
    of two numbers, however many ids there are. No id is lost; others pass by chance.
    """
    met, hit = _met_bits(df, column, ids, "inner")
    return met.where(hit).drop("_word", "_place", "_bits")


def roughly_marked(df: DataFrame, column: str, ids: DataFrame, mark: str) -> DataFrame:
    """All rows of ``df``, and whether :func:`roughly_in` would keep them."""
    met, hit = _met_bits(df, column, ids, "left")
    return met.withColumn(mark, F.coalesce(hit, F.lit(False))).drop("_word", "_place", "_bits")
