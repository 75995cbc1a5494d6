"""Cumulative analyses: running deal counts, revenue threshold dates, a focal
agent's share, new accounts over time.

Every running window runs on rows already aggregated to (key, day) or
(key, month): a window partition then holds at most one row per day or month,
however many deals one agent or product has.  Aggregating first is also what
makes the default RANGE frame exact: deals of one day are merged before the
running sum, as the RANGE frame merges ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import pct
from salescope.plans.model import WON, CrmModel


def cumulative_deals_by_product(model: CrmModel) -> DataFrame:
    """``(product, month, monthly_deals, cumulative_deals, total_deals_per_product)``."""
    monthly = model.measures(
        ["product", "month"], ("deals",), stages=(WON,), derived={"month": F.trunc("close_date", "month")}
    ).withColumnRenamed("deals", "monthly_deals")
    running = Window.partitionBy("product").orderBy("month")
    whole = Window.partitionBy("product")
    return monthly.select(
        "product",
        "month",
        "monthly_deals",
        F.sum("monthly_deals").over(running).alias("cumulative_deals"),
        F.sum("monthly_deals").over(whole).alias("total_deals_per_product"),
    ).orderBy(F.col("total_deals_per_product").desc(), "product", "month")


def threshold_date(model: CrmModel, amount: int) -> DataFrame:
    """``(sales_agent, hit_date)``: first close date at which an agent's running
    won revenue reaches ``amount``; agents that never reach it are absent."""
    daily = model.measures(["sales_agent", "close_date"], ("revenue",), stages=(WON,))
    running = Window.partitionBy("sales_agent").orderBy("close_date")
    return (
        daily.withColumn("cum_revenue", F.sum("revenue").over(running))
        .where(F.col("cum_revenue") >= F.lit(amount))
        .groupBy("sales_agent")
        .agg(F.min("close_date").alias("hit_date"))
        .orderBy("hit_date", "sales_agent")
    )


def focal_agent_share(model: CrmModel, agent: str) -> DataFrame:
    """``(product, focal_deals, other_deals, focal_pct)``: won deals of one agent
    against all others, per product (deals with no agent count as others).

    The agent is matched on the fact's own key (see
    :meth:`CrmModel.with_label_flag`), so deals aggregate straight to products.
    """
    fact = model.fact((WON,))
    grouped = (
        model.with_label_flag(fact, "sales_agent", agent, "__focal")
        .groupBy("product")
        .agg(F.count_if(F.col("__focal")).alias("focal_deals"), F.count_if(~F.col("__focal")).alias("other_deals"))
    )
    return grouped.withColumn(
        "focal_pct", pct(F.col("focal_deals"), F.col("focal_deals") + F.col("other_deals"))
    ).orderBy(F.col("focal_pct").desc(), "product")


def new_accounts_by_month(model: CrmModel) -> DataFrame:
    """``(month, new_customers_this_month, total_customers_to_date)``: accounts by
    the month of their first won deal ('yy-MM'), and the running total.

    One row per month: the running window over all months is tiny.
    """
    first = model.measures(["account"], ("first_close",), stages=(WON,))
    cohorts = first.groupBy(F.trunc("first_close", "month").alias("first_deal_month")).agg(
        F.count(F.lit(1)).alias("new_customers_this_month")
    )
    running = Window.orderBy("first_deal_month")
    return (
        cohorts.select(
            F.date_format("first_deal_month", "yy-MM").alias("month"),
            "new_customers_this_month",
            F.sum("new_customers_this_month").over(running).alias("total_customers_to_date"),
            "first_deal_month",
        )
        .orderBy("first_deal_month")
        .drop("first_deal_month")
    )
