"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from oracle import connect, frame_differences
from workload import QUERIES as OWN

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry_point.queries().items() if k in OWN}
SQL = {k: v for k, v in entry_point.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert {"report_date", "health_index", "health_status"} <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    problems = frame_differences(df, con, SQL[name])
    assert not problems, "\n".join(problems)
