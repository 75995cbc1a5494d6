"""Segmentation: agent quartile labels, account segments by statistical
thresholds inside home / non-home regions."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.operators.rank import agent_revenue
from salescope.operators.selection import ntile_by_selection
from salescope.plans.model import WON, CrmModel

# The four agent segments, best quartile first; the suffixes of
# the three account segments (high, low, in between).
AGENT_SEGMENTS = ("Top Performer", "Strong Performer", "Developing Performer", "Needs Improvement")
ACCOUNT_SEGMENTS = (" VIP", " Emerging", " Regular")


def agent_segment(
    model: CrmModel,
    outlier: str | None = None,
    exclude_outlier: bool = False,
    strategy: str = "distributed",
) -> DataFrame:
    """``(sales_agent, total_revenue, agent_segment)`` by revenue quartile.

    ``outlier`` is always labelled as the top segment.  By default it still
    takes part in the quartiles; ``exclude_outlier=True`` computes the
    quartiles without it.
    """
    ranked = agent_revenue(model)
    apart = exclude_outlier and outlier is not None
    is_outlier = F.col("sales_agent").eqNullSafe(F.lit(outlier))
    order = [F.col("total_revenue").desc(), F.col("sales_agent").asc()]
    if strategy == "window":
        spec = Window.partitionBy(is_outlier).orderBy(*order) if apart else Window.orderBy(*order)
        tiled = ranked.withColumn("__tile", F.ntile(4).over(spec))
    else:
        # an outlier left out takes no place among the others; its label is fixed
        tiled = ntile_by_selection(
            ranked, 4, ["total_revenue", "sales_agent"], [False, True], "__tile", takes=~is_outlier if apart else None
        )
    label = F.when(F.col("sales_agent") == F.lit(outlier), F.lit(AGENT_SEGMENTS[0])) if outlier else None
    for tile, name in enumerate(AGENT_SEGMENTS[:3], start=1):
        cond = F.col("__tile") == tile
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    label = label.otherwise(F.lit(AGENT_SEGMENTS[3]))
    return tiled.select("sales_agent", "total_revenue", label.alias("agent_segment"))


def _least_distance(k: Fraction) -> Column:
    """The least ``x`` for which an account whose ``n * won - sum`` is ``x`` or
    more is ``k`` standard deviations or more over the average, from a region's
    ``n``, ``s1`` (sum) and ``s2`` (sum of squares).

    That is ``x ** 2 * (n - 1) >= k ** 2 * n * (n * s2 - s1 ** 2)``.  Either side
    outgrows the 38 digits of a decimal at some 10**10 accounts, so the root is
    taken with Python's integers, on one row for each region.
    """
    if k < 0:
        raise ValueError(f"k must not be negative, got {k}")

    def least(n, s1, s2):
        n, s1, s2 = int(n), int(s1), int(s2)
        if n < 2:
            return None
        square = -(-(k.numerator**2 * n * (n * s2 - s1 * s1)) // (k.denominator**2 * (n - 1)))
        return Decimal(isqrt(square - 1) + 1 if square else 0)

    return F.udf(least, "decimal(38,0)")("n", "s1", "s2")


def account_segment(
    model: CrmModel,
    home: str,
    home_label: str | None = None,
    other_label: str | None = None,
    k: float | str | Fraction = 1.0,
) -> DataFrame:
    """``(account, office_location, won_deals, customer_segment)``.

    Accounts are split into the home region and the rest (no location counts
    as the rest).  Inside a region: VIP when won deals >= avg + k * stdev,
    Emerging when <= avg - k * stdev, else Regular (sample stdev; a region of
    one account has none and is all Regular).  ``k`` is taken exactly as it is
    written (0.0003 is 3/10000); negative and infinite ones raise.  The bounds
    are exact integers at any size (see :func:`_least_distance`), one row for
    each of the two regions, broadcast to the accounts.
    """
    home_label = home_label or home
    other_label = other_label or f"Non-{home}"
    counts = (
        model.measures(["account", "office_location"], ("deals",), stages=(WON,))
        .withColumnRenamed("deals", "won_deals")
        .withColumn(
            "region",
            F.when(F.col("office_location") == F.lit(home), F.lit(home_label)).otherwise(F.lit(other_label)),
        )
    )
    won = F.col("won_deals").cast("decimal(19,0)")
    stats = counts.groupBy("region").agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("n"),
        F.sum(won).cast("decimal(38,0)").alias("s1"),
        F.sum((won * won).cast("decimal(38,0)")).cast("decimal(38,0)").alias("s2"),
    )
    bounds = stats.select("region", "n", "s1", _least_distance(Fraction(str(k))).alias("least"))
    whole = lambda c: c.cast("decimal(38,0)")
    d = whole(F.col("n") * won) - F.col("s1")
    far = F.col("n") > 1
    segment = (
        F.when(far & (d >= F.col("least")), F.concat(F.col("region"), F.lit(ACCOUNT_SEGMENTS[0])))
        .when(far & (d <= -F.col("least")), F.concat(F.col("region"), F.lit(ACCOUNT_SEGMENTS[1])))
        .otherwise(F.concat(F.col("region"), F.lit(ACCOUNT_SEGMENTS[2])))
    )
    return (
        counts.join(F.broadcast(bounds), "region")
        .select("account", "office_location", "won_deals", segment.alias("customer_segment"))
        .orderBy("customer_segment", "won_deals", "account")
    )
