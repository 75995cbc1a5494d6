"""Monthly sales insights report: revenue, previous month, growth, running
totals.

Two grains are offered.

``sales_insights_view``: one row per (month, agent, product) of won deals,
with the previous row's revenue, the growth against it and the running
revenue and deal counts, all in (month, product) order inside an agent.  A
report keyed only by (month, agent) and (agent, product) would pair every
product row of an agent-month with every other one (k squared rows per
agent-month, times the months of each product); each row here is its own
pairing, never the cross product.

``agent_month_insights``: the corrected report, one row per (month, agent):
the previous *month's* revenue and growth, and running totals by month.

Both aggregate before any window, so the windowed rows are one agent's
months (times products), never its deals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import hundred
from salescope.operators.global_window import running_within
from salescope.plans.model import WON, CrmModel


def growth_pct(current: Column, previous: Column, scale: int = 6) -> Column:
    """``(current - previous) * 100.0 / previous``; NULL when previous is 0 or NULL."""
    return F.when(previous == 0, F.lit(None)).otherwise(
        F.round((current - previous) * hundred() / previous, scale)
    ).cast("double")


def _month() -> dict[str, Column]:
    return {"month": F.date_format("close_date", "yyyy-MM")}


def sales_insights_view(model: CrmModel, strategy: str = "distributed") -> DataFrame:
    """``(month, sales_agent, regional_office, product, revenue, prev_month_revenue,
    revenue_growth_pct, cum_revenue, cum_deals)`` per (month, agent, product).

    An agent's rows number months times products, which has no bound: the
    default strategy computes the running sums and the previous row without a
    window partition per agent (see :func:`running_within`);
    ``strategy='window'`` uses plain windows partitioned by agent.
    """
    monthly = model.measures(
        ["month", "sales_agent", "regional_office", "product"],
        ("deals", "revenue"),
        stages=(WON,),
        derived=_month(),
    )
    order = [F.col(c).asc() for c in ("month", "product", "regional_office")]
    if strategy == "window":
        by_agent = Window.partitionBy("sales_agent").orderBy(*order)
        running = by_agent.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        done = monthly.select(
            "*",
            F.lag("revenue").over(by_agent).alias("prev_month_revenue"),
            F.sum("revenue").over(running).alias("cum_revenue"),
            F.sum("deals").over(running).alias("cum_deals"),
        )
    else:
        done = running_within(
            monthly,
            ["sales_agent"],
            order,
            sums={"cum_revenue": "revenue", "cum_deals": "deals"},
            lags={"prev_month_revenue": "revenue"},
        )
    return done.select(
        "month",
        "sales_agent",
        "regional_office",
        "product",
        "revenue",
        "prev_month_revenue",
        growth_pct(F.col("revenue"), F.col("prev_month_revenue")).alias("revenue_growth_pct"),
        "cum_revenue",
        "cum_deals",
    )


def agent_month_insights(model: CrmModel) -> DataFrame:
    """``(month, sales_agent, regional_office, revenue, prev_month_revenue,
    revenue_growth_pct, cum_revenue, cum_deals)`` per (month, agent)."""
    monthly = model.measures(
        ["month", "sales_agent", "regional_office"],
        ("deals", "revenue"),
        stages=(WON,),
        derived=_month(),
    )
    by_agent = Window.partitionBy("sales_agent").orderBy("month")
    running = by_agent.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.lag("revenue").over(by_agent)
    return monthly.select(
        "month",
        "sales_agent",
        "regional_office",
        "revenue",
        prev.alias("prev_month_revenue"),
        growth_pct(F.col("revenue"), prev).alias("revenue_growth_pct"),
        F.sum("revenue").over(running).alias("cum_revenue"),
        F.sum("deals").over(running).alias("cum_deals"),
    )
