"""Exploration of dimensions, dates and measures; magnitude by any dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import int_div, pct
from salescope.operators.global_window import row_number_within
from salescope.plans.model import CLOSED_STAGES, FULL_SALES_COLUMNS, WON, CrmModel

# The eight dimensions the magnitude analysis is run for.
MAGNITUDE_DIMENSIONS = (
    "series",
    "product",
    "regional_office",
    "manager",
    "sales_agent",
    "sector",
    "account",
    "office_location",
)


def product_numbering(model: CrmModel, strategy: str = "distributed") -> DataFrame:
    """``(series, product, prodNO_by_series)``: products numbered inside a series.

    Ordered by product (the order inside a series is otherwise arbitrary).
    ``strategy='window'`` uses one window partition per series; the default
    spreads a large series over many tasks.
    """
    products = model.table("products").select("series", "product")
    if strategy == "window":
        w = Window.partitionBy("series").orderBy("product")
        return products.withColumn("prodNO_by_series", F.row_number().over(w).cast("long"))
    return row_number_within(products, ["series"], [F.col("product").asc()], "prodNO_by_series")


def team_size(model: CrmModel) -> DataFrame:
    """``(regional_office, manager, team_size)``: distinct agents per team."""
    return (
        model.table("teams")
        .groupBy("regional_office", "manager")
        .agg(F.countDistinct("sales_agent").alias("team_size"))
        .orderBy(F.col("regional_office").asc(), F.col("team_size").desc(), "manager")
    )


def account_count(model: CrmModel) -> DataFrame:
    """``(account_count)``: number of distinct accounts."""
    return model.table("accounts").agg(F.countDistinct("account").alias("account_count"))


def frequency(df: DataFrame, column: str, name: str, skip_nulls: bool = False) -> DataFrame:
    """``(column, name)``: row count per value, most frequent first."""
    if skip_nulls:
        df = df.where(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), column)


def accounts_by_sector(model: CrmModel) -> DataFrame:
    return frequency(model.table("accounts"), "sector", "accountsCount")


def accounts_by_location(model: CrmModel) -> DataFrame:
    return frequency(model.table("accounts"), "office_location", "accountsCount")


def accounts_by_holding(model: CrmModel) -> DataFrame:
    """Accounts per parent company (accounts without a parent are left out)."""
    return frequency(model.table("accounts"), "subsidiary_of", "accountsCount", skip_nulls=True)


def deals_by_stage(model: CrmModel) -> DataFrame:
    """``(deal_stage, deals_count)``: the pipeline funnel."""
    return model.measures(["deal_stage"], ("deals",)).withColumnRenamed("deals", "deals_count")


def date_bounds(model: CrmModel) -> DataFrame:
    """First and last engage and close dates (one row)."""
    return model.sales(["engage_date", "close_date"]).agg(
        F.min("engage_date").alias("first_engagement"),
        F.max("engage_date").alias("last_engagement"),
        F.min("close_date").alias("first_close"),
        F.max("close_date").alias("last_close"),
    )


def month_of_year_sales(model: CrmModel) -> DataFrame:
    """``(month_, qty_sold, total_sales)`` of won deals by calendar month
    number (the same month of different years is one group)."""
    return (
        model.measures(["month_"], ("deals", "revenue"), stages=(WON,), derived={"month_": F.month("close_date")})
        .select("month_", F.col("deals").alias("qty_sold"), F.col("revenue").alias("total_sales"))
        .orderBy("month_")
    )


# The names of the five headline measures.
KPI_NAMES = ("total sales", "qty sold", "avg price", "avg nego days", "deal win %")


def kpi_measures(model: CrmModel, value_type: str = "double") -> DataFrame:
    """``(measure_Name, measure_value)``: five KPIs from one pass over the deals.

    total sales and avg price are over all deals (open deals have no value
    and are skipped by the average, lost deals count as 0); qty sold counts
    won deals; the win percentage is over closed (won or lost) deals.
    Averages are integer averages truncated toward zero.

    The five values share one column of ``value_type``.  ``double`` is exact
    up to 2**53; ``decimal(38,2)`` keeps every measure exact at any scale
    (total sales of some 10**16 do not fit a double exactly).
    """
    won = F.col("deal_stage") == WON
    closed = F.col("deal_stage").isin(*CLOSED_STAGES)
    days = F.datediff(F.col("close_date"), F.col("engage_date"))
    one_pass = model.sales(["deal_stage", "engage_date", "close_date", "close_value"]).agg(
        F.sum("close_value").alias("total_sales"),
        F.count_if(won).alias("qty_sold"),
        F.count("close_value").alias("valued"),
        F.sum(days).alias("days"),
        F.count(days).alias("dated"),
        F.count_if(closed).alias("closed"),
    )
    values = [
        F.col("total_sales"),
        F.col("qty_sold"),
        int_div(F.col("total_sales"), F.col("valued")),
        int_div(F.col("days"), F.col("dated")),
        pct(F.col("qty_sold"), F.col("closed")),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("measure_Name"), v.cast(value_type).alias("measure_value"))
            for name, v in zip(KPI_NAMES, values, strict=True)
        ]
    )
    return one_pass.select(F.inline(rows))


def _check_dimension(dim: str) -> None:
    if dim not in FULL_SALES_COLUMNS:
        raise ValueError(f"unknown dimension {dim!r}; expected one of {FULL_SALES_COLUMNS}")


def magnitude(model: CrmModel, dim: str) -> DataFrame:
    """``(group_by_value, total_sales, qty_sold)`` of won deals by ``dim``.

    ``dim`` is any deal-frame column, validated before any job runs.
    """
    _check_dimension(dim)
    return (
        model.measures([dim], ("revenue", "deals"), stages=(WON,))
        .select(
            F.col(dim).alias("group_by_value"),
            F.col("revenue").alias("total_sales"),
            F.col("deals").alias("qty_sold"),
        )
        .orderBy(F.col("total_sales").desc(), "group_by_value")
    )


_PAIRS = "array<struct<dimension:string,group_by_value:string>>"


def magnitude_all(model: CrmModel, dims: Sequence[str] = MAGNITUDE_DIMENSIONS) -> DataFrame:
    """``(dimension, group_by_value, total_sales, qty_sold)`` for several
    dimensions from one scan of the deals, with GROUPING SETS over the keys.

    The deals are summed by each key alone; the sums (a row per key) meet the
    labels of all keys in one join.  Keys must be unique in their dimension.
    Values are cast to string so dimensions of different types share a column.
    """
    dims = list(dims)
    for d in dims:
        _check_dimension(d)
    partial, sources = model.by_key(dims, ("revenue", "deals"), stages=(WON,))
    text = lambda c: F.col(c).cast("string")
    pair = lambda d, v: F.struct(F.lit(d).alias("dimension"), v.alias("group_by_value"))
    # the labels of each key, in one table; a key without a row has NULL labels
    nothing = F.array().cast(_PAIRS)
    own, unknown, labels = nothing, nothing, None
    for key, (d, columns) in sources.items():
        here = F.col("key_name") == key
        others = [c for c in columns if c != key]
        unknown = F.when(here, F.array(*[pair(c, F.lit(None).cast("string")) for c in others]).cast(_PAIRS)).otherwise(unknown)
        own = F.when(here, F.array(pair(key, F.col("key_value"))).cast(_PAIRS)).otherwise(own) if key in columns else own
        if others:
            found = d.frame.select(F.lit(key).alias("key_name"), text(d.key).alias("key_value"), F.array(*[pair(c, text(c)) for c in others]).cast(_PAIRS).alias("found"))
            labels = found if labels is None else labels.unionByName(found)
    joined = partial.withColumn("found", F.lit(None).cast(_PAIRS)) if labels is None else partial.join(labels, ["key_name", "key_value"], "left")
    both = F.concat(F.coalesce("found", unknown), own)
    return (
        joined.select(F.inline(both), "revenue", "deals")
        .groupBy("dimension", "group_by_value")
        .agg(F.sum("revenue").alias("total_sales"), F.sum("deals").alias("qty_sold"))
    )
