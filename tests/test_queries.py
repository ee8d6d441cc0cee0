"""Every registered query of the tables' operators against its SQL."""

import pytest
from oracle import compare, connect

from tablewarden.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, sf, con):
    assert compare(QUERIES[name](spark, sf), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).first()["verdict"] == "OK"
    assert set(entry.oracle_sql()) <= set(entry.queries())
