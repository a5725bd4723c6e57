"""Session set-up and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "millrace", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the operators are tuned for.

    On a cluster the caller brings the session; nothing here is required for
    right results.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def salts(spark: SparkSession) -> int:
    """Into how many tasks a hot key is dealt: as many as a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def spread(df: DataFrame) -> DataFrame:
    """Rows of fewer files than there are cores, dealt out to all cores; others as they are.

    For work that costs far more than moving the rows, on tables too small to be
    split by the scan. Nothing depends on it but time.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a fresh temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to reliable shared storage, with its lineage cut.

    For plans that read the same rows twice and need both reads to agree
    (range splits, partition numbers) even if executors are lost in between.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
