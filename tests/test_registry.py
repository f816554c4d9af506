"""Every registered query at the smallest scale, next to its SQL where it has one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload.check import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SMALL).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql:
        assert differences(found, duck.execute(sql).df()) is None
    else:
        assert len(found) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
