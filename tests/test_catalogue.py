"""Every registered query against its DuckDB oracle (the driver's gate runs
the same comparison at sf0.01; here sf0.001 keeps the suite fast)."""

import pytest

import __spark_entry__ as entry_mod
from medallion.catalogue import oracle_sql, queries
from medallion.oracle_compare import compare, duckdb_connection, spark_to_pandas

from .conftest import SF_SMALL

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sp = spark_to_pandas(queries()[name](spark, SF_SMALL))
    od = con.execute(oracle_sql()[name]).df()
    ok, msg = compare(sp, od)
    assert ok, msg


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "position"
    assert set(queries()) <= set(entry_mod.queries())
    assert set(oracle_sql()) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
