"""Streams against the batch result, over several files with late and repeated rows."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.streaming import ingest as I


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


SCHEMA = "k string, v int, ts timestamp"
FILES = [
    [("a", 1, ts(1)), ("a", 2, ts(1, 5)), ("b", 1, ts(2))],
    [("a", 1, ts(1)), ("b", 3, ts(9)), ("c", 1, ts(9))],
    [("c", 5, ts(1)), ("b", 2, ts(10)), ("a", 0, ts(10))],
    [("d", 1, ts(1)), ("a", 4, ts(11))],
]


def land(spark, folder, upto=3):
    for i, rows in enumerate(FILES[:upto]):
        path = folder / "in" / f"{i}"
        if not path.exists():
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(path))


def source(spark, folder):
    return I.landed(spark, f"{folder}/in/*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_upsert_continues_where_it_stopped(spark, tmp_path):
    path, check = str(tmp_path / "out"), str(tmp_path / "check")
    version = [F.col("ts"), F.col("v")]
    for upto in (1, 2, 3, 3):
        land(spark, tmp_path, upto)
        I.stream_upsert(source(spark, tmp_path), ["k"], version, path, check)
        got = {r["k"]: r["v"] for r in I.current(spark, path, ["k"], version).collect()}
        rows = sorted((x for f in FILES[:upto] for x in f), key=lambda r: (r[2], r[1]))
        assert got == {k: v for k, v, _ in rows}
    I.compact(spark, path, ["k"], version)
    assert len(list((tmp_path / "out").glob("batch=*"))) == 1
    assert {r["k"]: r["v"] for r in I.current(spark, path, ["k"], version).collect()} == got
    # the stream goes on in the compacted table, and without its checkpoint lands again without harm
    land(spark, tmp_path, 4)
    for state in (check, str(tmp_path / "other")):
        I.stream_upsert(source(spark, tmp_path), ["k"], version, path, state)
        got = {r["k"]: r["v"] for r in I.current(spark, path, ["k"], version).collect()}
        assert got == {k: v for k, v, _ in sorted((x for f in FILES for x in f), key=lambda r: (r[2], r[1]))}


def test_dedup_over_batches(spark, tmp_path):
    land(spark, tmp_path)
    I.drain(I.stream_dedup(source(spark, tmp_path), ["k", "v"], "ts", "30 days"), str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted({(k, v) for f in FILES[:3] for k, v, _ in f})


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    land(spark, tmp_path, 4)
    counts = I.stream_daily_counts(source(spark, tmp_path), "ts", "k", "1 day")
    I.drain(counts, str(tmp_path / "out"), str(tmp_path / "check"))
    got = {(r["day"].day, r["k"]): r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # one file per batch; the second moves the watermark to day 8, which holds for
    # late rows from the batch after next, so only the fourth file's day 1 is lost
    assert got[(1, "a")] == 3 and got[(2, "b")] == 1 and got[(1, "c")] == 1 and (1, "d") not in got
