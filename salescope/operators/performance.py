"""Performance: win rates, sector revenue profile, negotiation time, sector
frequency.

Win rates are over *closed* deals here (won or lost), unlike the top-k win
rate, which is over all deals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import hundred, int_div, n2_percent, pct, ratio
from salescope.plans.model import CLOSED_STAGES, WON, CrmModel


def win_rate_by(model: CrmModel, by: list[str]) -> DataFrame:
    """``(<by>, total_deals, won_deals, win_rate)`` over closed deals."""
    return (
        model.measures(by, ("deals", "won_deals"), stages=CLOSED_STAGES)
        .withColumnRenamed("deals", "total_deals")
        .withColumn("win_rate", pct(F.col("won_deals"), F.col("total_deals")))
        .orderBy(F.col("win_rate").desc(), *by)
    )


def manager_win_rate(model: CrmModel) -> DataFrame:
    return win_rate_by(model, ["regional_office", "manager"])


def account_win_rate(model: CrmModel) -> DataFrame:
    return win_rate_by(model, ["account", "sector"])


def sector_performance(model: CrmModel) -> DataFrame:
    """``(sector, avg_deal_value, total_revenue, percent_of_total, sector_revenue_rank)``.

    ``percent_of_total`` is text, ``'12.34%'``.  One row per sector: the
    windows over all sectors (rank and total) are tiny.
    """
    grouped = model.measures(["sector"], ("revenue", "valued_deals"), stages=(WON,))
    total = F.sum("revenue").over(Window.partitionBy())
    share = hundred() * F.col("revenue") / F.nullif(total, F.lit(0))
    return grouped.select(
        "sector",
        int_div(F.col("revenue"), F.col("valued_deals")).alias("avg_deal_value"),
        F.col("revenue").alias("total_revenue"),
        n2_percent(share).alias("percent_of_total"),
        F.rank().over(Window.orderBy(F.col("revenue").desc())).cast("long").alias("sector_revenue_rank"),
    )


def negotiation_days(model: CrmModel) -> DataFrame:
    """``(sales_agent, avg_negotiation_days)``: whole days engage -> close of won
    deals, integer average."""
    return (
        model.measures(["sales_agent"], ("nego_days", "nego_deals"), stages=(WON,))
        .select("sales_agent", int_div(F.col("nego_days"), F.col("nego_deals")).alias("avg_negotiation_days"))
        .orderBy("avg_negotiation_days", "sales_agent")
    )


def sector_frequency(model: CrmModel) -> DataFrame:
    """``(sector, customers, total_deals, revenue, avg_spend, deal_frequency)``
    of won deals; ``deal_frequency`` = deals per distinct account (NULL
    when a sector's deals have no account)."""
    per_account = model.measures(["sector", "account"], ("deals", "revenue", "valued_deals"), stages=(WON,))
    grouped = per_account.groupBy("sector").agg(
        F.count("account").alias("customers"),
        F.sum("deals").alias("total_deals"),
        F.sum("revenue").alias("revenue"),
        F.sum("valued_deals").alias("valued"),
    )
    return grouped.select(
        "sector",
        "customers",
        "total_deals",
        "revenue",
        int_div(F.col("revenue"), F.col("valued")).alias("avg_spend"),
        ratio(F.col("total_deals"), F.col("customers")).alias("deal_frequency"),
    ).orderBy(F.col("total_deals").desc(), "sector")
