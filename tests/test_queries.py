"""Every registered query against its DuckDB oracle (the driver's check) on
the smallest scale factor, plus plan checks on the same DataFrame: no
cartesian products or nested-loop joins, no single-partition exchanges, no
row-at-a-time Python."""
import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())
BAD = ["CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BAD if b in plan], name
    r = compare(spark, con, name, None, E.oracle_sql().get(name), SF, sdf=df)
    assert r["status"] in ("MATCH", "rows-only"), r
    if r["status"] == "rows-only":
        assert r["spark_rows"] > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
