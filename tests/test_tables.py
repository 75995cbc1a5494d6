"""Tables, views and the function of the catalog; joins without a shuffle."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salescope.operators import explore, performance, report, segment
from salescope.plans.model import CrmModel
from salescope.plans.tables import LARGE, SALES, from_tables, large_keys, publish
from salescope.registry import STAR_PARAMS, analyses
from salescope.sources.crm import ACCOUNTS_SCHEMA, PRODUCTS_SCHEMA, SALES_SCHEMA, TEAMS_SCHEMA, model_from_frames
from salescope.sources.star import from_star
from tests.conftest import rows
from tests.fixture_crm import ACCOUNTS, PRODUCTS, TEAMS

SF = "/root/testdata/sf0.001"
#: One analysis of each kind of plan: frame, sums by key, by label, derived columns, several keys.
NAMES = (
    "account_win_rate account_segment magnitude_account magnitude_sector magnitude_product agent_month_insights "
    "location_share sector_performance null_counts kpi_measures non_home_products new_accounts_by_month deals_by_stage "
    "fk_violations accounts_without_won_deals full_sales"
).split()


def _database(spark, folder, name):
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    model = from_star(spark, SF)
    name = _database(spark, tmp_path_factory.mktemp("star"), "published_star")
    made = publish(model, name, buckets=4)
    yield model, name, made
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, star, name):
    model, database, _ = star
    plain, tables = (analyses(m, STAR_PARAMS)[name]() for m in (model, from_tables(spark, database, model)))
    assert tables.columns == plain.columns
    assert rows(tables) == rows(plain)


def _in(session, database):
    """Spark takes no database before a table function: it has to be the current one."""
    session.catalog.setCurrentDatabase(database)
    return session


def _tree(df):
    """``(depth, line)`` of the executed plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [(len(re.match(r"[\s:|+\-]*", line)[0]), line) for line in text.split("\n") if line.strip()]


def _below(plan, word, scan):
    """The lines between an operator and a scan that lies below it."""
    at = next(i for i, (_, line) in enumerate(plan) if scan in line)
    depth, path = plan[at][0], []
    for d, line in reversed(plan[:at]):
        if d < depth:
            depth = d
            path.append(line)
            if word in line:
                return path
    raise AssertionError((word, scan, plan))


def test_no_shuffle_between_deals_and_accounts(spark, star):
    model, database, _ = star
    tables = from_tables(spark, database, model).parts[0]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (tables.measures(["account"], ("deals",), ("Won",)), tables.frame(["opportunity_id", "account"])):
            plan = _tree(df)
            for table in (SALES, "accounts"):
                path = _below(plan, "SortMergeJoin", f"{database}.{table}[")
                assert not any("Exchange" in line for line in path), path
        plan = _tree(tables.measures(["account_key"], ("deals",)))
        assert not any("Exchange" in line for _, line in plan), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_key_that_holds_a_third_has_a_table_without_buckets(spark, tmp_path):
    day = dt.date(2024, 5, 1)
    deal = lambda i, account: (f"o{i}", TEAMS[i % 6][0], "Alpha Basic", account, "Won", day, day + dt.timedelta(i % 90), i)
    names = [f"Account {i}" for i in range(40)]
    deals = [deal(i, "Acorn Ltd" if i % 3 == 0 else None if i % 3 == 1 else names[i % 40]) for i in range(900)]
    model = model_from_frames(
        spark.createDataFrame(deals, SALES_SCHEMA),
        spark.createDataFrame(TEAMS, TEAMS_SCHEMA),
        spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA),
        spark.createDataFrame([*ACCOUNTS, *[(n, *ACCOUNTS[0][1:]) for n in names]], ACCOUNTS_SCHEMA),
    )
    assert rows(large_keys(model.fact(), "account", 8)) == [("Acorn Ltd",), (None,)]
    name = _database(spark, tmp_path, "published_hot")
    try:
        publish(model, name, buckets=8)
        assert spark.table(f"{name}.{LARGE}").count() == 600
        most = spark.table(f"{name}.{SALES}").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert most <= 2 * 900 // 8
        tables = from_tables(spark, name, model)
        for analysis in (performance.account_win_rate, report.agent_month_insights, lambda m: m.frame(), lambda m: m.measures(["account"]), lambda m: segment.account_segment(m, "Homeland")):
            assert rows(analysis(tables)) == rows(analysis(model))
        # published again, the tables are replaced; no deals give empty tables
        publish(CrmModel(lambda s: model.fact(s).limit(0), model.dims), name, buckets=2)
        assert from_tables(spark, name, model).frame().count() == 0
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    with pytest.raises(ValueError):
        publish(model, name, buckets=0)


def test_views_for_another_session(spark, star):
    model, database, made = star
    other = spark.newSession()
    insights = other.table(f"{database}.sales_insights")
    assert insights.columns == report.agent_month_insights(model).columns
    assert rows(insights) == rows(report.agent_month_insights(model))
    assert rows(other.table(f"{database}.full_sales_data")) == rows(model.frame())
    assert made["sales_insights"] == "view" and made["magnitude"] == "function"


@pytest.mark.parametrize("dim", ["sector", "product", "account", "revenue", "close_value", "deal_stage"])
def test_magnitude_in_sql(spark, star, dim):
    model, database, _ = star
    got = _in(spark.newSession(), database).sql(f"SELECT * FROM magnitude('{dim}')")
    # the branches of the other columns are gone
    scans = [line for _, line in _tree(got) if "FileScan" in line]
    assert len(scans) == 2 + (dim in ("sector", "account", "revenue"))
    won = model.frame([dim, *{"close_value"} - {dim}], ("Won",))
    want = won.groupBy(F.col(dim).cast("string").alias("group_by_value")).agg(F.sum("close_value"), F.count(F.lit(1)))
    assert got.columns == explore.magnitude(model, "sector").columns and rows(got) == rows(want)


def test_magnitude_refuses_other_names(spark, star):
    for argument in ("'no such column'", "NULL"):
        df = _in(spark.newSession(), star[1]).sql(f"SELECT * FROM magnitude({argument})")
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
        with pytest.raises(PySparkException, match="unknown dimension"):
            df.collect()


def test_published_files_lie_in_the_database(spark, star):
    folder = spark.sql(f"DESCRIBE DATABASE {star[1]}").where("info_name = 'Location'").first()[1]
    assert (Path(folder.removeprefix("file:")) / SALES).is_dir()
