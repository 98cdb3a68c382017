"""Every registered query against its SQL statement, on the smallest data set."""

import os

import pytest

from tools.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _names():
    from showcase import all_queries
    return sorted(all_queries())


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", _names())
def test_query(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    problem, rows, _ = compare(spark, duck, queries()[name], oracle_sql().get(name), SF)
    assert not problem
    assert rows >= 0


def test_every_query_has_sql():
    from showcase import all_queries
    assert all(sql for _, sql in all_queries().values())


def test_entry_registers_every_query():
    from __spark_entry__ import oracle_sql, queries
    from showcase import all_queries
    assert set(all_queries()) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    from __spark_entry__ import entry
    found = entry(spark)
    assert {"variable", "n_scope", "completeness_pct", "implemented"} <= set(found.columns)
    assert found.count() > 0
