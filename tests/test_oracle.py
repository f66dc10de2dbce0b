"""Differential test: every registered query vs its DuckDB oracle SQL (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, norm_type, rows  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "pct" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toArrow()
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle for this query")
    exp = con.sql(sql).to_arrow_table()
    assert {f.name: norm_type(f.type) for f in got.schema} == {f.name: norm_type(f.type) for f in exp.schema}
    assert got.num_rows == exp.num_rows
    assert rows(got) == rows(exp)
