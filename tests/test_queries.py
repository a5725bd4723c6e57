"""Every registered query against its SQL, at the smallest scale."""

import pytest

from oracle import ORACLES, QUERIES, compare, connect


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, folder, key):
    assert compare(spark, con, folder, key) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["area", "hour", "day_type", "n", "mean"] and df.count() > 0
    assert e.queries().keys() >= QUERIES.keys() and e.oracle_sql().keys() >= ORACLES.keys()


def test_python_steps_need_no_package_on_the_executors(tmp_path):
    """Run away from the repository, where workers cannot import it."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert e.entry(spark).count() > 0
for key in ["fn_js_f2_balanced_json", "sx_09_welch_t_p", "sx_10_chi2_p", "tx_07_extract_items", "src_04_zipped_csv"]:
    assert e.queries()[key](spark, "/root/testdata/sf0.001").count() > 0, key
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
