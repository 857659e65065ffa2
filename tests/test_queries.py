"""Every registered query against its SQL (or that it runs, where there is none)."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, tables

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return tables(sf)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, con, name):
    fn = entry.queries()[name]
    if name in SQL:
        n, problems = compare(spark, con, sf, fn, SQL[name])
        assert not problems, problems
    else:
        assert fn(spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["device_id", "windowEnd"]
