"""Part-to-whole: shares of the won revenue, Pareto running share,
home-country split.

The grand total is a scalar subquery over the already grouped rows
(``DataFrame.scalar()``): computed once by a distributed aggregate, then used
as a constant, so no ``Exchange SinglePartition`` of the grouped rows and no
second scan of the deals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import hundred, pct, ratio
from salescope.plans.model import WON, CrmModel


def with_share(grouped: DataFrame, value: str, name: str = "percent_of_total", also: tuple[str, ...] = ()) -> DataFrame:
    """Add ``name`` = ROUND(100.0 * value / SUM(value), 2) over all rows.

    ``also``: the other aggregates of ``grouped``.  They are summed with the
    value, because a subquery that is pruned to fewer columns can't share the
    shuffle of ``grouped`` and would read the deals again.
    """
    sums = [F.sum(value).alias("total"), *[F.sum(c).alias(c) for c in also]]
    total = grouped.agg(F.struct(*sums)).scalar()["total"]
    return grouped.withColumn(name, pct(F.col(value), total))


def _won_revenue_by(model: CrmModel, dim: str, value_name: str) -> DataFrame:
    return model.measures([dim], ("revenue",), stages=(WON,)).withColumnRenamed("revenue", value_name)


def series_share(model: CrmModel) -> DataFrame:
    """``(series, total_sales, percent_of_total)``."""
    return with_share(_won_revenue_by(model, "series", "total_sales"), "total_sales").orderBy(
        F.col("percent_of_total").desc(), "series"
    )


def location_share(model: CrmModel) -> DataFrame:
    """``(office_location, total_sales, percent_of_total)``."""
    return with_share(_won_revenue_by(model, "office_location", "total_sales"), "total_sales").orderBy(
        F.col("percent_of_total").desc(), "office_location"
    )


def sector_pareto(model: CrmModel) -> DataFrame:
    """``(sector, total_sales, percent_of_total, running_percent)``.

    The running share accumulates sectors in descending share order (ties by
    sector name).  One row per sector: the window over all sectors is tiny.
    """
    shares = with_share(_won_revenue_by(model, "sector", "total_sales"), "total_sales")
    total = shares.agg(F.sum("total_sales")).scalar()
    order = Window.orderBy(F.col("percent_of_total").desc(), F.col("sector").asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = F.sum("total_sales").over(order)
    return shares.withColumn(
        "running_percent", F.round(hundred() * running / F.nullif(total, F.lit(0)), 2).cast("double")
    ).orderBy(F.col("percent_of_total").desc(), F.col("sector").asc())


def series_part_to_whole(model: CrmModel) -> DataFrame:
    """``(series, revenue, percent_of_total)``; equals :func:`series_share`."""
    return with_share(_won_revenue_by(model, "series", "revenue"), "revenue")


def home_vs_other(model: CrmModel, home: str, other: str = "Other") -> DataFrame:
    """``(region, revenue, percent_of_total)``: home country vs the rest.

    Accounts with no location fall in ``other``.
    """
    by_location = _won_revenue_by(model, "office_location", "revenue")
    region = F.when(F.col("office_location") == F.lit(home), F.lit(home)).otherwise(F.lit(other))
    grouped = by_location.groupBy(region.alias("region")).agg(F.sum("revenue").alias("revenue"))
    return with_share(grouped, "revenue")


def non_home_products(model: CrmModel, home: str) -> DataFrame:
    """``(product, won_deals_count, total_revenue, deals_pct, avg_deal_price)``
    for won deals of accounts located outside ``home``.

    ``office_location != home`` drops accounts with no location (unlike the
    ELSE branch of :func:`home_vs_other`).
    """
    abroad = model.where_label(model.fact((WON,)), "office_location", lambda c: c != F.lit(home))
    grouped = abroad.groupBy("product").agg(
        F.count(F.lit(1)).alias("won_deals_count"), F.sum("close_value").alias("total_revenue")
    )
    return (
        with_share(grouped, "won_deals_count", "deals_pct", also=("total_revenue",))
        .withColumn("avg_deal_price", ratio(F.col("total_revenue"), F.col("won_deals_count")))
        .orderBy(F.col("won_deals_count").desc(), "product")
    )
