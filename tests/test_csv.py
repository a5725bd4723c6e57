"""CSV as other programs write it, read by several tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.plans.catalog import QUERIES
from millrace.sources import csv_records, readers, writers

SCHEMA = "k long, a string, b string, c string"


def some_rows(n, seed):
    rng = random.Random(seed)
    pieces = ['"', '""', ",", "\n", "\r\n", "\n\n", " ", "  pad ", "é", "한글", "a", "text", "'", "\\", '\\"', "x,y"]
    rows = []
    for k in range(n):
        fields = ["".join(rng.choice(pieces) for _ in range(rng.choice([1, 1, 2, 5]))) if rng.random() < 0.7 else rng.choice(["", None, "plain"]) for _ in range(3)]
        if k % 97 == 5:
            fields[1] = "\n".join(f"line {j} of a long field" for j in range(120))
        rows.append((k, *fields))
    return rows


def written_by_others(rows, end="\r\n"):
    """A quoted empty field for '', an unquoted one for null, quotes where they are needed or by chance."""
    rng, out = random.Random(1), ["k,a,b,c"]
    for row in rows:
        fields = []
        for v in row:
            if v is None:
                fields.append("")
            else:
                v = str(v)
                needs = v == "" or any(c in v for c in '",\n\r') or rng.random() < 0.2
                fields.append('"' + v.replace('"', '""') + '"' if needs else v)
        out.append(",".join(fields))
    return end.join(out) + end


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_split_file(spark, tmp_path, small_blocks, end):
    rows = some_rows(800, 3)
    text = written_by_others(rows, end)
    (tmp_path / "one.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    df = readers.read_csv(spark, str(tmp_path / "one.csv"), SCHEMA)
    assert ordered(df) == rows
    blocks = spark.read.text(str(tmp_path / "one.csv")).select(F.col("_metadata.file_block_start")).distinct().count()
    assert blocks > 30  # fields of 2,600 bytes cross several of them
    # the standard library reads the same, but for null
    same = [tuple(r) for r in csv.reader(io.StringIO(text, newline=""))][1:]
    assert same == [tuple("" if v is None else str(v) for v in r) for r in rows]


def test_many_unusual_blocks_are_shuffled(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(csv_records, "BROADCAST_BLOCKS", 2)
    rows = some_rows(300, 4)
    (tmp_path / "one.csv").write_bytes(written_by_others(rows).encode())
    assert ordered(readers.read_csv(spark, str(tmp_path / "one.csv"), SCHEMA)) == rows


def test_several_files_and_encodings(spark, tmp_path, small_blocks):
    parts = [some_rows(200, s) for s in range(4)]
    codes = ["utf-8", "cp949", "utf-8-sig", "cp949"]
    strip = lambda rows: [tuple(v.replace("é", "e") if isinstance(v, str) else v for v in r) for r in rows]
    for n, (rows, code) in enumerate(zip(map(strip, parts), codes)):
        (tmp_path / f"{n}.csv").write_bytes(written_by_others(rows).encode(code))
    df = readers.read_csv(spark, str(tmp_path), SCHEMA, fallback="cp949", source_file="f")
    got = {n: sorted(tuple(r)[:4] for r in df.where(F.col("f").endswith(f"/{n}.csv")).collect()) for n in range(4)}
    plain = lambda rows: [tuple(r) for r in rows]
    assert {n: sorted(rows, key=lambda r: r[0]) for n, rows in got.items()} == {n: plain(strip(rows)) for n, rows in enumerate(parts)}
    with pytest.raises(Exception, match="UTF8|UTF-8|utf-8"):
        readers.read_csv(spark, str(tmp_path / "1.csv"), SCHEMA).collect()
    (tmp_path / "wide.csv").write_bytes(written_by_others(strip(parts[0]), "\n").encode("utf-16"))
    assert ordered(readers.read_csv(spark, str(tmp_path / "wide.csv"), SCHEMA, "UTF-16")) == strip(parts[0])


def test_round_trip(spark, tmp_path, small_blocks):
    rows = some_rows(400, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    writers.write_csv(df.coalesce(2), str(tmp_path / "out"), mark=True)
    assert ordered(readers.read_csv(spark, str(tmp_path / "out"), SCHEMA)) == rows


def test_one_file_of_many_tasks(spark, tmp_path, small_blocks):
    rows, path = some_rows(400, 11), str(tmp_path / "out")
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for n in (len(rows), 0, len(rows)):  # takes the place of an older file; no rows give a header
        writers.write_csv(df.where(F.col("k") < n), path, mark=True, one_file=True)
        (file,) = [f for f in (tmp_path / "out").iterdir() if f.suffix == ".csv"]
        text = file.read_bytes().decode()
        assert text.startswith("\ufeff") and text.count("\ufeff") == 1 and text.count("k,a,b,c\n") == 1
        assert ordered(readers.read_csv(spark, path, SCHEMA)) == rows[:n]
    assert [f.name for f in tmp_path.iterdir()] == ["out"]


def test_no_task_of_the_one_file_query_has_all_rows(spark, tmp_path, monkeypatch):
    spark.range(4000).selectExpr("id as doc_id", "repeat('some text ', 20) as text", "'en' as lang", "'s' as source").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    most, write = [], writers.write_csv

    def counted(df, *args, **kw):
        most.append(df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        write(df, *args, **kw)

    monkeypatch.setattr(writers, "write_csv", counted)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    assert QUERIES["snk_01_quoted_csv"](spark, str(tmp_path)).count() == 4000
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert most[0] <= 1000


def test_odd_ends(spark, tmp_path):
    cases = {"open": ('k,a\n1,"never closed\nto the end', [(1, "never closed\nto the end")]), "empty": ("", []), "header": ("k,a\n", []), "no_end": ("k,a\n1,x", [(1, "x")]), "blank": ('k,a\n\n1,x\n   \n2,"y\n\nz"\n', [(1, "x"), (2, "y\n\nz")])}
    for name, (text, want) in cases.items():
        (tmp_path / f"{name}.csv").write_text(text)
        assert ordered(readers.read_csv(spark, str(tmp_path / f"{name}.csv"), "k long, a string")) == want, name
