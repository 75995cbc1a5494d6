"""Rankings: top-k agents, revenue rank, quartile tiers.

Every ordering carries the agent name as a tie-breaker, so results do not
depend on partitioning.  Agents grow with the data, so by default ranks over
them use the distributed global window and tiles the selection of the rows that
end them; ``strategy='window'`` gives the plain single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import pct
from salescope.operators.global_window import global_rank
from salescope.operators.selection import ntile_by_selection
from salescope.operators.share import with_share
from salescope.plans.model import WON, CrmModel

TEAM = ["regional_office", "manager", "sales_agent"]


def top_agents_by_value(model: CrmModel, n: int = 10) -> DataFrame:
    """``(regional_office, manager, sales_agent, total_sales)``: the ``n`` agents
    with the most won revenue (top-k: the limit is the feature)."""
    return (
        model.measures(TEAM, ("revenue",), stages=(WON,))
        .withColumnRenamed("revenue", "total_sales")
        .orderBy(F.col("total_sales").desc(), F.col("sales_agent").asc())
        .limit(n)
    )


def top_agents_by_win_rate(model: CrmModel, n: int = 10) -> DataFrame:
    """``(regional_office, manager, sales_agent, total_deals, won_deals, win_rate)``:
    the ``n`` agents with the best share of won deals among *all* their deals."""
    return (
        model.measures(TEAM, ("deals", "won_deals"))
        .withColumnRenamed("deals", "total_deals")
        .withColumn("win_rate", pct(F.col("won_deals"), F.col("total_deals")))
        .orderBy(F.col("win_rate").desc(), F.col("sales_agent").asc())
        .limit(n)
    )


def agent_revenue(model: CrmModel, name: str = "total_revenue") -> DataFrame:
    """``(sales_agent, <name>)``: won revenue per agent."""
    return model.measures(["sales_agent"], ("revenue",), stages=(WON,)).withColumnRenamed("revenue", name)


def agent_revenue_rank(model: CrmModel, strategy: str = "distributed") -> DataFrame:
    """``(sales_agent, total_revenue, revenue_rank)``: rank by revenue, gaps on ties."""
    revenue = agent_revenue(model)
    if strategy == "window":
        return revenue.withColumn(
            "revenue_rank", F.rank().over(Window.orderBy(F.col("total_revenue").desc())).cast("long")
        )
    return global_rank(revenue, ["total_revenue"], [False], "revenue_rank")


def agent_tier(model: CrmModel, tiles: int = 4, strategy: str = "distributed") -> DataFrame:
    """``(sales_agent, total_revenue, percent_of_total, performance_tier)``:
    share of won revenue and quartile (``tiles``) by revenue."""
    shares = with_share(agent_revenue(model), "total_revenue")
    order = [F.col("total_revenue").desc(), F.col("sales_agent").asc()]
    if strategy == "window":
        return shares.withColumn("performance_tier", F.ntile(tiles).over(Window.orderBy(*order)))
    return ntile_by_selection(shares, tiles, ["total_revenue", "sales_agent"], [False, True], "performance_tier")
