"""Every query with a SQL twin must match DuckDB on the smallest data set;
the flagship entry must run."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .conftest import SF_SMALL
from .oracle_compare import compare, duck

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    res = compare(spark, SF_SMALL, name, queries()[name], ORACLE[name], con)
    assert res["status"] == "match", res


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) >= {"log_prediction", "sale_price"}
    assert all(r.sale_price > 0 for r in rows)
