"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from newsmill.plans.catalogue import CATALOGUE
from tests.compare import connect, difference

QUERIES = {name: run for name, run in entry.queries().items() if name in CATALOGUE}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in CATALOGUE}

# Joins over all pairs, row-wise Python, and aggregates that hold a whole group in memory.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "percentile(", "collect_set"]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() >= 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_inventory_row_has_a_query():
    answered = {r for q in CATALOGUE.values() for r in q.rows}
    assert set(range(1, 140)) - answered == set()


def test_names_and_sql_belong_together():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)
