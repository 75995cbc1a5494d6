"""Every analysis on the hand-made fixture against the same oracle SQL run by
DuckDB on the fixture tables: NULL keys, unmatched keys, NULL locations,
zero revenue, ties and a single-account region all go through both engines."""

from __future__ import annotations

import duckdb
import pytest

from salescope.oracle import CRM_BASE, build_sql
from salescope.registry import Params, analyses
from tests.fixture_crm import ACCOUNTS, PRODUCTS, REPAIR, SALES, TEAMS
from tools.compare_oracle import canon

PARAMS = Params(home="Homeland", focal_agent="Blake Reed", threshold=500)
SQL = build_sql(CRM_BASE, PARAMS.home, PARAMS.focal_agent, PARAMS.threshold, PARAMS.top_n, star=False)

DDL = {
    "sales": "opportunity_id VARCHAR, sales_agent VARCHAR, product VARCHAR, account VARCHAR, deal_stage VARCHAR, "
    "engage_date DATE, close_date DATE, close_value BIGINT",
    "teams": "sales_agent VARCHAR, manager VARCHAR, regional_office VARCHAR",
    "products": "product VARCHAR, series VARCHAR, sales_price INTEGER",
    "accounts": "account VARCHAR, sector VARCHAR, year_established INTEGER, revenue DECIMAL(12,2), "
    "employees INTEGER, office_location VARCHAR, subsidiary_of VARCHAR",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    repaired = [(r[0], r[1], REPAIR.get(r[2], r[2]), *r[3:]) for r in SALES]
    for name, data in (("sales", repaired), ("teams", TEAMS), ("products", PRODUCTS), ("accounts", ACCOUNTS)):
        c.execute(f"CREATE TABLE {name} ({DDL[name]})")
        c.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_analysis_matches_sql_on_fixture(crm, con, name):
    df = analyses(crm, PARAMS)[name]()
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, got) == canon(cols, cur.fetchall())
