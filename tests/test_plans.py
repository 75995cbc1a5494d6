"""Physical-plan properties the scale design relies on."""

from __future__ import annotations

import re

from salescope.operators import cumulative, explore, rank, report
from salescope.sources.star import from_star

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stage_filter_and_columns_reach_the_scan(spark):
    model = from_star(spark, SF)
    plan = _plan(explore.magnitude(model, "sector"))
    assert "EqualTo(o_orderstatus,F)" in plan
    # only the columns the analysis needs are read from lineitem
    scan = next(line for line in plan.split("\n") if "lineitem" in line and "FileScan" in line)
    assert "l_shipdate" not in scan and "l_linenumber" not in scan


def test_deals_are_aggregated_before_the_dimension_join(spark):
    model = from_star(spark, SF)
    plan = _optimized(rank.agent_revenue(model))
    # the first aggregate (by agent key) sits below the join with the teams dimension
    join_at = plan.index("Join LeftOuter")
    agg_by_key = [m.start() for m in re.finditer(r"Aggregate \[agent_key", plan)]
    assert agg_by_key and max(agg_by_key) > join_at


def test_no_single_partition_window_over_agents(spark):
    model = from_star(spark, SF)
    for df in (rank.agent_revenue_rank(model), rank.agent_tier(model), report.sales_insights_view(model)):
        plan = _plan(df)
        lines = plan.split("\n")
        for line, child in zip(lines, lines[1:], strict=False):
            if "SinglePartition" in line:
                # only per-partition statistics and the sums of a total (one row per partition) go to one task
                assert "__pid" in plan or "HashAggregate(keys=[]" in child, child
        windows = [line for line in lines if "Window [" in line and "windowspecdefinition" in line]
        assert all("__pid" in line or "unboundedfollowing" in line or "__last" in line for line in windows), windows


def test_running_windows_see_aggregated_rows(spark):
    model = from_star(spark, SF)
    plan = _optimized(cumulative.threshold_date(model, 1000))
    window_at = plan.index("Window [")
    assert "Aggregate [sales_agent" in plan[window_at:]


def test_focal_share_joins_the_agent_keys_without_a_hint(spark):
    model = from_star(spark, SF)
    df = cumulative.focal_agent_share(model, "Supplier#000000001")
    # one join of the agent's keys, planned by statistics; no (product, agent) aggregate
    joins = [line for line in _optimized(df).split("\n") if "Join LeftOuter" in line]
    assert len(joins) == 1 and "agent_key" in joins[0] and "Hint" not in joins[0]
    assert not re.search(r"keys=\[product#\d+L?, agent_key", _plan(df))
