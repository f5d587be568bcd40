"""Every registered query against its SQL twin on the smallest sample."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.conftest import SF_SMALL

OWN = entry._SUITE.builds  # the add-on's queries have tests of their own
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name in ORACLE:
        problems = [p for p in compare(df, con, ORACLE[name]) if not p.startswith("note")]
        assert not problems
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
