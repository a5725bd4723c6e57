"""Marts kept up to date day by day."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import marts as M

NAMES = ("user", "area", "place", "kind", "value", "ts")


def fact(spark, rows):
    return M.hourly_fact(spark.createDataFrame(rows, "ts timestamp, user long, kind string, value double"), "ts")


def marts(fine):
    return {name: sorted(map(str, df.collect())) for name, df in M.marts_of(fine, "area", "place", "kind").items()}


@pytest.fixture
def rows():
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 4)
    return [(start + dt.timedelta(minutes=rng.randrange(5 * 1440)), rng.choice([1, 2, 3, 9, None]), rng.choice(["a", "b", None]), rng.choice([1.5, 2.0, None])) for _ in range(400)]


def test_days(spark, tmp_path, rows):
    dim = spark.createDataFrame([(1, "x", "p"), (2, "x", "q"), (3, "y", "r")], "user long, area string, place string")
    path = str(tmp_path / "days")
    days = [dt.date(2024, 1, 4 + k) for k in range(5)]
    whole = lambda rows: marts(M.fine_mart(fact(spark, rows), dim, "user", "area", "place", "kind", "value"))
    kept = lambda: marts(spark.read.parquet(path))
    M.refresh_days(fact(spark, rows), dim, *NAMES, path, days[:3])
    assert kept() == whole([r for r in rows if r[0].date() < days[3]])

    # one day comes: the files of the others stay as they are
    before = {f: open(f, "rb").read() for f in glob.glob(f"{path}/day=*/*.parquet")}
    M.refresh_days(fact(spark, rows), dim, *NAMES, path, days[3:])
    after = glob.glob(f"{path}/day=*/*.parquet")
    assert set(before) < set(after) and all(open(f, "rb").read() == body for f, body in before.items())
    assert kept() == whole(rows)

    # rows of one day change, those of another all go; a repeated call changes nothing
    changed = [(*r[:3], 7.0) if r[0].date() == days[1] else r for r in rows if r[0].date() != days[2]]
    for _ in range(2):
        M.refresh_days(fact(spark, changed), dim, *NAMES, path, days[1:3])
        assert kept() == whole(changed)

    # a failure leaves the table as it was
    broken = fact(spark, changed).withColumn("value", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        M.refresh_days(broken, dim, *NAMES, path, days)
    M.refresh_days(broken, dim, *NAMES, path, [])
    assert kept() == whole(changed)
