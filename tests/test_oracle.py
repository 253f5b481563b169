"""Every registered query with an oracle matches DuckDB on the small fixture (sf0.001)."""
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert compare(df, con, SQL[name]) == []


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["carrier", "late_pct", "n"]
    assert df.count() > 0
