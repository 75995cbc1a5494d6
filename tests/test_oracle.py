"""Every registered analysis against its DuckDB SQL on the star mapping."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from salescope import registry
from tools.compare_oracle import canon

SF = "/root/testdata/sf0.001"
# Spark type name -> DuckDB type name of the same values
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
QUERIES = registry.QUERIES
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, got) == canon(cols, want)
    duck_types = dict(zip(cols, (str(t) for t in con.sql(SQL[name]).types), strict=True))
    assert {c: TYPES.get(t, t.upper()) for c, t in df.dtypes} == duck_types


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["regional_office", "manager", "sales_agent", "total_sales"]
    assert 0 < df.count() <= 10
