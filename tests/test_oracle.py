"""Every registered query against its DuckDB SQL at sf0.01 (the driver's gate)."""

import pytest

from kinroll.registry import ORACLE_SQL, QUERIES
from tools.oracle_check import compare, duckdb_connection

from .conftest import SF01


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE_SQL
    r = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert r["rows"][0] == r["rows"][1], r
    assert r["columns"], r
    assert r["values"], r["diff"]


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["l_returnflag", "doc_count", "sp"]
    assert df.count() >= 1
