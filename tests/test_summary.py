"""Key summaries: equal results with and without them, and no scan of the deals."""

import pytest
from pyspark.sql import functions as F

from salescope.operators import quality
from salescope.plans.model import FACT_COLUMNS, distinct_values
from salescope.plans.summary import key_summary, with_key_summary, write_key_summary
from salescope.registry import STAR_PARAMS, analyses, analysis_names
from salescope.sources.star import from_star

SF = "/root/testdata/sf0.001"
#: Analyses that a summary answers alone.
ANSWERED = (
    "orphan_products accounts_without_won_deals products_without_won_deals fk_violations null_counts deals_by_stage magnitude_all series_share "
    "location_share sector_pareto top10_agents_value top10_agents_win_rate agent_revenue_rank manager_win_rate "
    "account_win_rate agent_tier agent_segment account_segment key_summary magnitude_sales_agent magnitude_sector"
).split()


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    star = from_star(spark, SF)
    path = str(tmp_path_factory.mktemp("summary") / "keys")
    write_key_summary(star, path)
    return star, with_key_summary(spark, star, path)


@pytest.mark.parametrize("name", analysis_names(STAR_PARAMS))
def test_same_rows_on_the_star(models, name):
    plain, summed = (analyses(m, STAR_PARAMS)[name]() for m in models)
    assert summed.dtypes == plain.dtypes
    assert rows(summed) == rows(plain)


@pytest.mark.parametrize("name", ANSWERED)
def test_the_deals_are_not_read(models, name):
    found = analyses(models[1], STAR_PARAMS)[name]()
    assert not any("lineitem" in f for f in found.inputFiles())


def test_same_rows_on_the_fixture(spark, crm, tmp_path):
    """NULL and unmatched keys, NULL labels, open deals."""
    write_key_summary(crm, str(tmp_path / "keys"))
    summed = with_key_summary(spark, crm, str(tmp_path / "keys"))
    params = STAR_PARAMS
    for name in analysis_names(params):
        plain, other = (analyses(m, params)[name]() for m in (crm, summed))
        assert rows(other) == rows(plain), name


def test_summary_is_one_row_per_key_and_stage(models):
    found = key_summary(models[1])
    assert found.count() == found.select("key_name", "key_value", "deal_stage").distinct().count()
    deals = models[0].fact().count()
    assert {r["n"] for r in found.groupBy("key_name").agg(F.sum("deals").alias("n")).collect()} == {deals}


def test_bitmaps_count_exactly(spark):
    data = [(i * 3 - 500, i % 7, None if i % 5 else i, "x" if i % 2 else None) for i in range(1000)]
    data += [(-(2**63), 1, 2**63 - 1, "x"), (2**63 - 1, 1, -1, "y"), (-1, 1, -64, "y"), (None, None, None, None)] * 2
    df = spark.createDataFrame(data, "a long, b long, c long, d string").withColumn("e", F.date_add(F.lit("1969-12-01").cast("date"), F.coalesce("b", F.lit(400)).cast("int")))
    got = distinct_values(df, ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"])
    found = {r["key_name"]: r["n"] for r in got.groupBy("key_name").agg(F.sum("n_values").alias("n")).collect()}
    assert found == {c: df.select(c).where(F.col(c).isNotNull()).distinct().count() for c in df.columns}


def test_dense_identifiers_shuffle_few_rows(spark):
    df = spark.range(64_000).select(F.col("id").alias("a"))
    assert distinct_values(df, ["a"], ["a"]).count() == 1000


def test_distinct_counts_of_the_star(models):
    got = {(r["table_name"], r["column_name"]): r["n_distinct"] for r in quality.distinct_counts(models[0]).collect()}
    sales = models[0].sales(FACT_COLUMNS)
    for c in FACT_COLUMNS:
        assert got["sales", c] == sales.select(c).where(F.col(c).isNotNull()).distinct().count()
