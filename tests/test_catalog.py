"""Differential test: every catalogue entry against its DuckDB oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check import TABLES, canon

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.CATALOGUE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = canon(df.columns, df.collect())
    rel = duck.sql(E.oracle_sql()[key])
    o_cols, o_rows = canon(rel.columns, rel.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "transaction_id" in df.columns
