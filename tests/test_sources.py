"""Readers: explicit schemas, empty field -> NULL, doubled quotes; the star
mapping's shape."""

from __future__ import annotations

import os
import tempfile

from salescope.plans.model import FULL_SALES_COLUMNS
from salescope.sources.crm import DICTIONARY_SCHEMA, load_crm, read_table
from salescope.sources.star import from_star
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_load_crm_csv(spark):
    folder = tempfile.mkdtemp(prefix="salescope-csv-", dir="/tmp")
    sales = _write(
        folder,
        "s.csv",
        "opportunity_id,sales_agent,product,account,deal_stage,engage_date,close_date,close_value\n"
        "A1,Ann,P1,Co,Won,2017-01-02,2017-01-09,120\n"
        "A2,Ann,P1,,Engaging,2017-02-01,,\n",
    )
    teams = _write(folder, "t.csv", "sales_agent,manager,regional_office\nAnn,Bob,East\n")
    products = _write(folder, "p.csv", "product,series,sales_price\nP1,PX,55\n")
    accounts = _write(
        folder,
        "a.csv",
        "account,sector,year_established,revenue,employees,office_location,subsidiary_of\n"
        "Co,retail,1999,10.25,12,Homeland,\n",
    )
    model = load_crm(spark, sales, teams, products, accounts)
    frame = model.frame()
    assert frame.columns == list(FULL_SALES_COLUMNS)
    got = {r.opportunity_id: r for r in frame.collect()}
    assert got["A1"].manager == "Bob" and got["A1"].subsidiary_of is None and got["A1"].close_value == 120
    assert got["A2"].account is None and got["A2"].close_date is None and got["A2"].close_value is None
    d = _write(folder, "d.csv", 'Table,Field,Description\nsales,engage_date,"Date the ""Engaging"" stage began"\n')
    (row,) = read_table(spark, d, DICTIONARY_SCHEMA).collect()
    assert row.description == 'Date the "Engaging" stage began'


def test_star_mapping_shape(spark):
    model = from_star(spark, SF)
    frame = model.frame()
    assert frame.columns == list(FULL_SALES_COLUMNS)
    types = dict(frame.dtypes)
    assert types["engage_date"] == "date" and types["close_value"] == "bigint"
    stages = dict(rows(frame.groupBy("deal_stage").count()))
    assert set(stages) == {"Won", "Lost", "Engaging"}
    # every won deal has a positive value and a close date not before its engage date
    bad = frame.where("deal_stage = 'Won' AND (close_value IS NULL OR close_date < engage_date)").count()
    assert bad == 0


def test_frame_joins_only_needed_dimensions(spark):
    model = from_star(spark, SF)
    plan = model.frame(["deal_stage", "close_value"])._jdf.queryExecution().optimizedPlan().toString()
    assert "s_suppkey" not in plan and "c_custkey" not in plan and "p_partkey" not in plan
    plan = model.frame(["manager", "close_value"])._jdf.queryExecution().optimizedPlan().toString()
    assert "s_suppkey" in plan and "c_custkey" not in plan and "p_partkey" not in plan


def test_snapshot_round_trip_and_views(spark):
    from salescope.operators import explore, rank
    from salescope.plans.snapshot import from_snapshot, register_views, write_snapshot

    model = from_star(spark, SF)
    path = tempfile.mkdtemp(prefix="salescope-snap-", dir="/tmp") + "/deals"
    write_snapshot(model, path)
    snap = from_snapshot(spark, path, model)
    assert rows(rank.agent_revenue(snap)) == rows(rank.agent_revenue(model))
    assert rows(explore.magnitude(snap, "sector")) == rows(explore.magnitude(model, "sector"))
    plan = explore.magnitude(snap, "sector")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "s_suppkey" not in plan
    names = register_views(model, prefix="t_")
    assert "t_full_sales_data" in names
    n = spark.sql("SELECT COUNT(*) FROM t_full_sales_data WHERE deal_stage = 'Won'").collect()[0][0]
    assert n == model.frame(["deal_stage"], stages=("Won",)).count()


def test_load_crm_parquet(spark):
    from salescope.operators import share
    from tests.fixture_crm import frames

    folder = tempfile.mkdtemp(prefix="salescope-pq-", dir="/tmp")
    paths = {}
    for name, df in zip(("sales", "teams", "products", "accounts"), frames(spark), strict=True):
        paths[name] = os.path.join(folder, name)
        df.write.parquet(paths[name])
    model = load_crm(spark, fmt="parquet", **paths)
    assert dict(model.frame().dtypes)["revenue"] == "decimal(12,2)"
    # unrepaired: the misspelt product has no series and forms the NULL group
    got = {s: t for s, t, _ in rows(share.series_share(model))}
    assert got[None] == 250 and got["Alpha"] == 1002
