"""Results do not depend on the number of shuffle partitions (catches missing
tie-breakers), and property checks across analyses."""

from __future__ import annotations

import pytest

from salescope.operators import cumulative, rank, report, share
from salescope.registry import QUERIES
from salescope.sources.star import from_star
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
NAMES = [
    "agent_tier",
    "agent_segment",
    "agent_revenue_rank",
    "top10_agents_value",
    "top10_agents_win_rate",
    "sector_pareto",
    "sector_performance",
    "sales_insights_view",
    "agent_month_insights",
    "product_numbering",
    "threshold_date",
    "cumulative_deals_by_product",
    "new_accounts_by_month",
]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_1_and_64_partitions(spark, name):
    results = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            results.append(rows(QUERIES[name](spark, SF)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_properties_on_star(spark):
    model = from_star(spark, SF)
    assert rows(share.series_share(model)) == rows(share.series_part_to_whole(model))
    shares = [p for _, _, p in rows(share.series_share(model))]
    assert abs(sum(shares) - 100) <= 0.01 * len(shares)
    # last running total per product = product total
    for p, _, _, cum, total in rows(cumulative.cumulative_deals_by_product(model)):
        assert cum <= total
    # the corrected report ends at each agent's revenue
    revenue = dict(rows(rank.agent_revenue(model)))
    last = {}
    for m, a, _, _, _, _, cum, _ in rows(report.agent_month_insights(model)):
        last[a] = cum
    assert last == revenue
    # new accounts: the last running total is the number of accounts with a won deal
    cohorts = rows(cumulative.new_accounts_by_month(model))
    assert max(t for _, _, t in cohorts) == sum(n for _, n, _ in cohorts)
