"""Every query with an oracle must equal its DuckDB SQL on the smallest fixture."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"model", "band", "rmse", "count", "proportion"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dk = con.execute(SQL[name]).df()
    assert compare(sp, dk) == "OK", name
