"""The SQL of the corpus queries, and that nothing outside the subpackage needs it."""

import re
from pathlib import Path

import pytest

from millrace.llm.queries import ORACLES, QUERIES
from oracle import connect, duck_rows, spark_rows


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, key):
    assert spark_rows(QUERIES[key](spark, folder)) == duck_rows(connect(folder), ORACLES[key])


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).parents[2]
    for file in [*root.glob("millrace/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in file.relative_to(root).parts:
            assert not re.search(r"millrace\.llm|corpus_pipeline", file.read_text()), file
