"""Every registered query against its SQL on the smallest data, and the shape of its plan."""

import re
from pathlib import Path

import pytest

from suite import registered

SF = "/root/testdata/sf0.001"
QUERIES = registered()


@pytest.fixture(scope="module")
def con():
    from check import database

    return database(SF)


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    from check import compare

    run, sql = QUERIES[name]
    df = run(spark, SF)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, sql, con) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    # No pairs of everything with everything, and no Python row by row.
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    if not name.startswith("ols_inference"):
        assert "Python" not in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    if Path(SF).exists():
        assert entry.entry(spark).count() > 0
