"""Every registered query against its SQL on the smallest tables."""

import os
import re
import subprocess
import sys

import pytest
from compare import connect, differences

from barorail.checks import catalog

SF_DIR = os.environ.get("BARORAIL_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # No window over everything: that would sort all rows in one task. The one over range sizes has
    # at most 257 rows.
    assert not re.search(r"Window \[(?!sum\(_size)[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        assert not df.isEmpty()


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["type_ligne", "axe_label"]


@pytest.mark.parametrize("missing", ["zstandard", "barorail.llm", "corpus_pipeline"])
def test_queries_without_an_optional_part(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; "
        "assert len(e.queries()) > 130 and 'pipeline' not in e.queries(); assert set(e.oracle_sql()) <= set(e.queries())"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, check=True)
