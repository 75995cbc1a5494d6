"""The driver's TPC-H-like tables read as the CRM star (test mapping).

=================  ==========================================================
deal (fact)        ``lineitem JOIN orders`` on the order key, one deal per
                   line item
opportunity_id     ``l_orderkey * 10 + l_linenumber`` (a label, not unique)
sales_agent        supplier name (via ``l_suppkey``)
product            ``l_partkey``
account            customer name (via ``o_custkey``)
deal_stage         order status F / P / O -> Won / Lost / Engaging
engage_date        earlier of order date and ship date
close_date         later of the two, for Won and Lost deals
close_value        Won: extended price rounded to a whole amount; Lost: 0;
                   open: NULL
teams              supplier -> nation (manager) -> region (regional office)
products           part: brand is the series, retail price the list price
accounts           customer: market segment is the sector, account balance
                   the revenue, nation name the office location; founding
                   year, head count and parent company are derived from the
                   customer key
=================  ==========================================================

Agents and accounts are joined by their surrogate keys (``l_suppkey``,
``o_custkey``), each base table once; the names come from the dimension.
Names are unique per key in these tables, so this equals the name joins of
the analysed scripts while keeping the fact away from a second supplier and
customer join.  ``nation`` (25 rows) and ``region`` (5 rows) have a size
fixed by the TPC-H specification and are broadcast explicitly; supplier,
customer and part grow with the scale factor and are left to the planner's
size statistics (auto-broadcast threshold) and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.plans.model import CrmModel, Dimension

# Order status code -> deal stage.
STATUS_TO_STAGE = {"F": "Won", "P": "Lost", "O": "Engaging"}

# Schemas of the driver tables (columns the mapping reads).  Explicit schemas
# skip the footer read that schema inference does for every table at planning.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_brand string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_extendedprice double, l_shipdate timestamp_ntz"
    ),
}

# Parameters of the mapping (see FIXTURES.md): the home country of the
# part-to-whole and segmentation analyses, and the focal / outlier agent.
HOME_COUNTRY = "NATION_0"
FOCAL_AGENT = "Supplier#000000001"


def _stage_expr(status: str) -> F.Column:
    expr = None
    for code, stage in STATUS_TO_STAGE.items():
        cond = F.col(status) == F.lit(code)
        expr = F.when(cond, F.lit(stage)) if expr is None else expr.when(cond, F.lit(stage))
    return expr


def from_star(spark: SparkSession, sf_dir: str) -> CrmModel:
    """CRM model over ``{sf_dir}/{table}.parquet``."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    nation = F.broadcast(read("nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(read("region").select("r_regionkey", "r_name"))

    teams = (
        read("supplier")
        .select("s_suppkey", "s_name", "s_nationkey")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("s_suppkey").alias("agent_key"),
            F.col("s_name").alias("sales_agent"),
            F.col("n_name").alias("manager"),
            F.col("r_name").alias("regional_office"),
        )
    )
    products = read("part").select(
        F.col("p_partkey").alias("product"),
        F.col("p_brand").alias("series"),
        F.col("p_retailprice").alias("sales_price"),
    )
    custkey = F.col("c_custkey")
    accounts = (
        read("customer")
        .select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            custkey.alias("account_key"),
            F.col("c_name").alias("account"),
            F.col("c_mktsegment").alias("sector"),
            (F.lit(1979) + custkey % 39).cast("int").alias("year_established"),
            F.col("c_acctbal").alias("revenue"),
            (F.lit(9) + custkey % 34280).cast("int").alias("employees"),
            F.col("n_name").alias("office_location"),
            F.when(
                custkey % 7 == 0,
                F.concat(F.lit("Customer#"), F.lpad(F.expr("c_custkey div 10").cast("string"), 9, "0")),
            ).alias("subsidiary_of"),
        )
    )

    facts: dict[tuple[str, ...] | None, DataFrame] = {}

    def fact(stages: tuple[str, ...] | None) -> DataFrame:
        if stages not in facts:
            facts[stages] = _fact(stages)
        return facts[stages]

    def _fact(stages: tuple[str, ...] | None) -> DataFrame:
        orders = read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        if stages is not None:
            codes = [code for code, stage in STATUS_TO_STAGE.items() if stage in stages]
            orders = orders.where(F.col("o_orderstatus").isin(codes))
        lines = read("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
        )
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        order_day = F.col("o_orderdate").cast("date")
        ship_day = F.col("l_shipdate").cast("date")
        status = F.col("o_orderstatus")
        closed = status.isin("F", "P")
        return joined.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("opportunity_id"),
            F.col("l_suppkey").alias("agent_key"),
            F.col("l_partkey").alias("product"),
            F.col("o_custkey").alias("account_key"),
            _stage_expr("o_orderstatus").alias("deal_stage"),
            F.least(order_day, ship_day).alias("engage_date"),
            F.when(closed, F.greatest(order_day, ship_day)).alias("close_date"),
            F.when(status == "F", F.round(F.col("l_extendedprice")).cast("long"))
            .when(status == "P", F.lit(0).cast("long"))
            .alias("close_value"),
        )

    return CrmModel(
        fact_builder=fact,
        dims=(
            Dimension(
                "teams",
                teams,
                key="agent_key",
                provides=("sales_agent", "manager", "regional_office"),
                table_columns=("sales_agent", "manager", "regional_office"),
            ),
            Dimension(
                "products",
                products,
                key="product",
                provides=("series", "sales_price"),
                table_columns=("product", "series", "sales_price"),
            ),
            Dimension(
                "accounts",
                accounts,
                key="account_key",
                provides=(
                    "account",
                    "sector",
                    "year_established",
                    "revenue",
                    "employees",
                    "office_location",
                    "subsidiary_of",
                ),
                table_columns=(
                    "account",
                    "sector",
                    "year_established",
                    "revenue",
                    "employees",
                    "office_location",
                    "subsidiary_of",
                ),
            ),
        ),
    )
