"""Operators that SQL can express equal their SQL on the whole tables."""

import duckdb
import pytest

from salescope.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = con.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    wanted = sorted(found.fetchall())
    ours = QUERIES[name](spark, SF)
    assert sorted(ours.columns) == sorted(columns)
    assert sorted(map(tuple, ours.select(*columns).collect())) == wanted
