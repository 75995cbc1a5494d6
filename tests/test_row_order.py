"""Rows come in the promised order, whose last key leaves no tie."""

from __future__ import annotations

import pytest

from salescope.registry import QUERIES

SF = "/root/testdata/sf0.001"
#: Sort keys of the ordered analyses; ``-`` marks a descending one.
ORDER = {
    "team_size": ["regional_office", "-team_size", "manager"],
    "accounts_by_sector": ["-accountsCount", "sector"],
    "accounts_by_location": ["-accountsCount", "office_location"],
    "month_of_year_sales": ["month_"],
    "magnitude_sector": ["-total_sales", "group_by_value"],
    "magnitude_product": ["-total_sales", "group_by_value"],
    "sector_pareto": ["-percent_of_total", "sector"],
    "top10_agents_value": ["-total_sales", "sales_agent"],
    "top10_agents_win_rate": ["-win_rate", "sales_agent"],
    "cumulative_deals_by_product": ["-total_deals_per_product", "product", "month"],
    "threshold_date": ["hit_date", "sales_agent"],
    "focal_agent_share": ["-focal_pct", "product"],
    "new_accounts_by_month": ["total_customers_to_date"],
    "manager_win_rate": ["-win_rate", "manager"],
    "account_win_rate": ["-win_rate", "account"],
    "negotiation_days": ["avg_negotiation_days", "sales_agent"],
    "sector_frequency": ["-total_deals", "sector"],
    "non_home_products": ["-won_deals_count", "product"],
    "account_segment": ["customer_segment", "won_deals", "account"],
}


def _key(column):
    return lambda row: (row[column] is not None, 0 if row[column] is None else row[column])


@pytest.mark.parametrize("name", ORDER)
def test_rows_in_order(spark, name):
    found = [row.asDict() for row in QUERIES[name](spark, SF).collect()]
    assert found
    expected = list(reversed(found))  # ties, if any, come out the other way
    for column in reversed(ORDER[name]):
        expected.sort(key=_key(column.lstrip("-")), reverse=column.startswith("-"))
    assert found == expected
