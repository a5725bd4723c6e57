"""Tables that are replaced as a whole, and joins of bucketed tables."""

import pytest
from pyspark.sql import functions as F

from millrace.plans.catalog import QUERIES
from millrace.sources import writers


def failing(df):
    return df.withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string")
    writers.publish(df, path, ["k"])
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="broken"):
        writers.publish(failing(df), path)
    assert spark.read.parquet(path).count() == 5
    writers.publish(spark.read.parquet(path).where("k < 2"), path)  # from itself, too
    assert spark.read.parquet(path).count() == 2


def test_catalogue_tables(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string")
    writers.publish_table(df, "published", ["k"], path=str(tmp_path))
    with pytest.raises(Exception, match="broken"):
        writers.publish_table(failing(df), "published", path=str(tmp_path))
    assert spark.table("published").count() == 5
    writers.publish_table(df.limit(1), "published", bucket_by=["k"], buckets=2, path=str(tmp_path))
    assert spark.table("published").count() == 1
    spark.sql("drop table published")


def test_bucketed_tables_meet_without_a_shuffle(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["snk_02_publish_table"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
