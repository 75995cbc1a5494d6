"""The model as tables, views and a function of the catalog, for other sessions.

:func:`publish` writes the deals and the dimensions into a database.  The deals
and one dimension (accounts) are bucketed and sorted by their key, so that
joins of the two and aggregates by the key need no shuffle.  A bucket is read by
one task; deals of a key that would outgrow its bucket are kept in a table of
their own without buckets and take the ordinary plan (combine in the task, then
a shuffle of the sums).  :func:`from_tables` reads both as a model.

The catalog also gets permanent views (``full_sales_data``, ``sales_insights``)
and a table function, ``SELECT * FROM magnitude('sector')`` (the database has to
be the current one: Spark takes no database before a table function).  They last
as long as the catalog: a metastore on a cluster, the application with
Spark's in-memory catalog.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.plans.model import FULL_SALES_COLUMNS, WON, CrmModel, merged

#: Tables of the deals: of ordinary keys by bucket, and of large keys.
SALES, LARGE = "sales", "sales_of_large_keys"
_LARGE_KEY = "__large_key"


@dataclass(frozen=True, eq=False)
class PartedModel(CrmModel):
    """A model whose deals lie in parts; each is joined and summed by key by
    itself, and only the sums meet."""

    parts: tuple[CrmModel, ...] = ()

    def frame(
        self,
        columns: Sequence[str] = FULL_SALES_COLUMNS,
        stages: Sequence[str] | None = None,
        matched: Mapping[str, str] | None = None,
    ) -> DataFrame:
        return reduce(DataFrame.unionAll, [p.frame(columns, stages, matched) for p in self.parts])

    def measures(
        self,
        by: Sequence[str],
        which: Sequence[str] = ("deals", "revenue"),
        stages: Sequence[str] | None = None,
        derived: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        found = [p._labelled(list(by), which, stages, derived)[0] for p in self.parts]
        return merged(reduce(DataFrame.unionAll, found), by, which)


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def large_keys(fact: DataFrame, key: str, buckets: int) -> DataFrame:
    """The values of ``key`` (NULL too) that more than one in ``buckets`` rows
    hold; there are fewer than ``buckets``."""
    counts = fact.groupBy(F.col(key).alias(_LARGE_KEY)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(F.col("n") * buckets > total).select(_LARGE_KEY)


def publish(model: CrmModel, database: str, buckets: int, dimension: str = "accounts") -> dict[str, str]:
    """Write the model into ``database`` (which exists), replacing earlier
    tables, and return what was made by kind.

    Choose ``buckets`` so that one in so many deals, the most a bucketed key can
    have, fit a task twice over.  The keys that hold more are fewer than ``buckets``;
    they are broadcast to part the deals.  The dimension has to be unique by
    its key for the buckets to be even; results don't depend on it.
    """
    if buckets < 1:
        raise ValueError(f"buckets must be positive, got {buckets}")
    side, fact = model.dim(dimension), model.fact()
    spark = fact.sparkSession
    large = F.broadcast(large_keys(fact, side.key, buckets))
    same = F.col(side.key).eqNullSafe(F.col(_LARGE_KEY))

    def write(df: DataFrame, table: str) -> None:
        writer = df.write.mode("overwrite").format("parquet")
        if side.key in df.columns and table in (SALES, side.name):
            # one file a bucket: sorted, so that a merge join needs no sort
            writer = df.repartition(buckets, side.key).write.mode("overwrite").format("parquet")
            writer = writer.bucketBy(buckets, side.key).sortBy(side.key)
        writer.saveAsTable(_name(database, table))

    write(fact.join(large, same, "left_anti"), SALES)
    write(fact.join(large, same, "left_semi"), LARGE)
    for d in model.dims:
        write(d.frame.select(d.key, *[c for c in d.provides if c != d.key]), d.name)
    made = {SALES: "table", LARGE: "table"} | {d.name: "table" for d in model.dims}
    for name, text in _views(model, database).items():
        spark.sql(f"CREATE OR REPLACE VIEW {_name(database, name)} AS {text}")
        made[name] = "view"
    spark.sql(_magnitude(model, database))
    return made | {"magnitude": "function"}


def from_tables(spark: SparkSession, database: str, like: CrmModel) -> CrmModel:
    """The model that :func:`publish` wrote; ``like`` gives the shape of the
    dimensions (their frames are not read)."""
    dims = tuple(replace(d, frame=spark.table(_name(database, d.name))) for d in like.dims)

    def part(*names: str) -> CrmModel:
        def fact(stages: tuple[str, ...] | None) -> DataFrame:
            found = reduce(DataFrame.unionAll, [spark.table(_name(database, n)) for n in names])
            return found if stages is None else found.where(F.col("deal_stage").isin(list(stages)))

        return CrmModel(fact_builder=fact, dims=dims)

    return PartedModel(fact_builder=part(SALES, LARGE).fact_builder, dims=dims, parts=(part(SALES), part(LARGE)))


# --- SQL -----------------------------------------------------------------------


def _quoted(name: str) -> str:
    return f"`{name}`"


def _deals(database: str, columns: Sequence[str], where: str = "") -> str:
    listed = ", ".join(map(_quoted, columns))
    return " UNION ALL ".join(f"SELECT {listed} FROM {_name(database, t)}{where}" for t in (SALES, LARGE))


def _views(model: CrmModel, database: str) -> dict[str, str]:
    """The deal frame, and the report by agent and month with the previous
    month, growth and running totals (:func:`operators.report.agent_month_insights`)."""
    joins = " ".join(f"LEFT JOIN {_name(database, d.name)} USING ({_quoted(d.key)})" for d in model.dims)
    full = f"SELECT {', '.join(map(_quoted, FULL_SALES_COLUMNS))} FROM ({_deals(database, model.fact().columns)}) {joins}"
    key = _quoted(model.dim("teams").key)
    by_key = f"""
        SELECT {key}, date_format(close_date, 'yyyy-MM') AS month, sum(close_value) AS revenue, count(*) AS deals
        FROM ({_deals(database, [model.dim("teams").key, "close_date", "close_value"], f" WHERE deal_stage = '{WON}'")})
        GROUP BY ALL"""
    insights = f"""
        WITH monthly AS (
            SELECT month, sales_agent, regional_office, sum(revenue) AS revenue, sum(deals) AS deals
            FROM ({by_key}) LEFT JOIN {_name(database, "teams")} USING ({key})
            GROUP BY month, sales_agent, regional_office
        ), beside AS (
            SELECT *, lag(revenue) OVER agent AS before,
                   sum(revenue) OVER so_far AS cum_revenue, sum(deals) OVER so_far AS cum_deals
            FROM monthly
            WINDOW agent AS (PARTITION BY sales_agent ORDER BY month),
                   so_far AS (PARTITION BY sales_agent ORDER BY month ROWS UNBOUNDED PRECEDING)
        )
        SELECT month, sales_agent, regional_office, revenue, before AS prev_month_revenue,
               CAST(round((revenue - before) * 100.0 / nullif(before, 0), 6) AS DOUBLE) AS revenue_growth_pct,
               cum_revenue, cum_deals
        FROM beside"""
    return {"full_sales_data": full, "sales_insights": insights}


def _magnitude(model: CrmModel, database: str) -> str:
    """``magnitude(dim)``: won revenue and deals by any column of the deal frame.

    A function's argument can't name a column, so there is a branch for each
    column; all but one fold away once the argument is known.  A name that is no
    column raises in a plan that reads no table.
    """
    own, branches = set(model.fact().columns), []
    for c in FULL_SALES_COLUMNS:
        d = model._supplier_of(c, own)
        key = c if d is None else d.key
        sums = f"""SELECT {_quoted(key)}, sum(close_value) AS won_value, count(*) AS won_deals
            FROM ({_deals(database, dict.fromkeys([key, "close_value"]), f" WHERE deal_stage = '{WON}'")}) GROUP BY {_quoted(key)}"""
        labels = "" if d is None else f" LEFT JOIN {_name(database, d.name)} USING ({_quoted(key)})"
        branches.append(
            f"""SELECT CAST({_quoted(c)} AS STRING), sum(won_value), sum(won_deals) FROM ({sums}){labels}
            WHERE magnitude.dim = '{c}' GROUP BY {_quoted(c)}"""
        )
    known = ", ".join(f"'{c}'" for c in FULL_SALES_COLUMNS)
    refused = f"""SELECT CAST(NULL AS STRING), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
        WHERE CASE WHEN magnitude.dim IN ({known}) THEN false ELSE raise_error('unknown dimension: ' || coalesce(magnitude.dim, 'NULL')) END"""
    return f"""CREATE OR REPLACE FUNCTION {_name(database, "magnitude")}(dim STRING)
        RETURNS TABLE (group_by_value STRING, total_sales BIGINT, qty_sold BIGINT)
        RETURN {" UNION ALL ".join([*branches, refused])}"""
