"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        same, message = compare(df, con, ORACLE[name])
        assert same, message
    else:
        assert df.count() > 0


def test_entry_has_rows(spark, sf_dir):
    assert entry.entry(spark).limit(1).count() == 1
