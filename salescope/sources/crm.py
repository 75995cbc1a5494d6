"""Readers for the CRM tables in their own shape (CSV with header, or Parquet).

Explicit schemas, no inference: inference scans the data once more and
guesses types per file.  Empty CSV fields read as NULL (Spark's default),
which is how a missing parent company must be read.  Dimensions join the
fact by name, as the analysed scripts do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.plans.model import CrmModel, Dimension

SALES_SCHEMA = T.StructType(
    [
        T.StructField("opportunity_id", T.StringType()),
        T.StructField("sales_agent", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("deal_stage", T.StringType()),
        T.StructField("engage_date", T.DateType()),
        T.StructField("close_date", T.DateType()),
        T.StructField("close_value", T.LongType()),
    ]
)
TEAMS_SCHEMA = T.StructType(
    [
        T.StructField("sales_agent", T.StringType()),
        T.StructField("manager", T.StringType()),
        T.StructField("regional_office", T.StringType()),
    ]
)
PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("sales_price", T.IntegerType()),
    ]
)
ACCOUNTS_SCHEMA = T.StructType(
    [
        T.StructField("account", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("year_established", T.IntegerType()),
        T.StructField("revenue", T.DecimalType(12, 2)),
        T.StructField("employees", T.IntegerType()),
        T.StructField("office_location", T.StringType()),
        T.StructField("subsidiary_of", T.StringType()),
    ]
)
DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read one table.  CSV: header line, UTF-8, ``""`` as an escaped quote."""
    if fmt == "csv":
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path)
        )
    if fmt == "parquet":
        return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    raise ValueError(f"unsupported format {fmt!r}")


def model_from_frames(
    sales: DataFrame, teams: DataFrame, products: DataFrame, accounts: DataFrame
) -> CrmModel:
    """CRM model from four DataFrames in the CRM shape (name-keyed dimensions)."""

    def fact(stages: tuple[str, ...] | None) -> DataFrame:
        return sales if stages is None else sales.where(F.col("deal_stage").isin(list(stages)))

    return CrmModel(
        fact_builder=fact,
        dims=(
            Dimension(
                "teams",
                teams,
                key="sales_agent",
                provides=("manager", "regional_office"),
                table_columns=tuple(TEAMS_SCHEMA.fieldNames()),
            ),
            Dimension(
                "products",
                products,
                key="product",
                provides=("series", "sales_price"),
                table_columns=tuple(PRODUCTS_SCHEMA.fieldNames()),
            ),
            Dimension(
                "accounts",
                accounts,
                key="account",
                provides=tuple(ACCOUNTS_SCHEMA.fieldNames()[1:]),
                table_columns=tuple(ACCOUNTS_SCHEMA.fieldNames()),
            ),
        ),
    )


def load_crm(
    spark: SparkSession,
    sales: str,
    teams: str,
    products: str,
    accounts: str,
    fmt: str = "csv",
) -> CrmModel:
    """CRM model from four files (or directories) of one format."""
    return model_from_frames(
        read_table(spark, sales, SALES_SCHEMA, fmt),
        read_table(spark, teams, TEAMS_SCHEMA, fmt),
        read_table(spark, products, PRODUCTS_SCHEMA, fmt),
        read_table(spark, accounts, ACCOUNTS_SCHEMA, fmt),
    )
