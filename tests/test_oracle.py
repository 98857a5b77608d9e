"""Every registered query against its SQL on the small test tables."""

import pytest

import compare
from tidemark.catalog import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, small, name):
    query = QUERIES[name]
    df = query.run(spark, small)
    if query.sql is None:
        assert df.count() > 0
        return
    assert compare.difference(df, con, query.sql) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
