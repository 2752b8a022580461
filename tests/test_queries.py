"""Every registered catalogue query against its SQL on the smallest tables."""

import pytest

from larder.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, small, oracle, same):
    same(QUERIES[name](spark, small), oracle.execute(SQL[name]))


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
