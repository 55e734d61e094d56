"""Every query with a SQL counterpart against DuckDB."""

import pytest

import __spark_entry__ as entry_points
from oracle_check import connect, difference
from visitlens.catalog.oracle import ORACLE


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, duck, name):
    df = entry_points.queries()[name](spark, data)
    assert difference(df, ORACLE[name], duck) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert slow not in plan


def test_entry_gives_rows(spark):
    df = entry_points.entry(spark)
    assert "target" in df.columns
    assert df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
