"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from rentgrid.binding import queries as bound
from rentgrid.binding.listings import listings

FOLDER = "/root/testdata/sf0.001"
# the optional training-data queries have tests of their own
QUERIES, ORACLE = bound.registered(), bound.oracle()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan
    if name in ORACLE:
        assert difference(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_layers_are_built_once(spark):
    assert listings(spark, FOLDER) is listings(spark, FOLDER)
