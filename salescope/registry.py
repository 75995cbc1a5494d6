"""The catalog of analyses, and its binding to the star-schema test mapping.

:func:`analyses` lists every analysis of a model as a lazy DataFrame,
given the parameters the analysed scripts hard-code (home country, focal /
outlier agent, revenue threshold).  ``QUERIES[name](spark, sf_dir)`` binds
the catalog to the driver's tables (``{sf_dir}/*.parquet``) with the
mapping's parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salescope.operators import cumulative, explore, performance, quality, rank, report, segment, share
from salescope.plans.model import CrmModel
from salescope.plans.session import session_key
from salescope.plans.summary import key_summary
from salescope.sources.star import FOCAL_AGENT, HOME_COUNTRY, from_star

# Parameter of the threshold analysis on the mapping (see FIXTURES.md).
THRESHOLD = 9_000_000
# The repair that the mapping is run with (an agent's name as it should be).
REPAIRED_AGENT = "Focal Agent"

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Params:
    """Parameters of the analyses."""

    home: str
    focal_agent: str
    threshold: int
    top_n: int = 10
    tiles: int = 4
    kpi_type: str = "decimal(38,2)"
    repairs: tuple[tuple[str, str], ...] = ()


def _catalog(p: Params) -> dict[str, Callable[[CrmModel], DataFrame]]:
    return {
        # preparation and data quality
        "orphan_products": quality.orphan_products,
        "value_repair": lambda m: quality.value_repair(m, dict(p.repairs) or None),
        "accounts_without_won_deals": quality.accounts_without_won_deals,
        "products_without_won_deals": quality.products_without_won_deals,
        "repeated_opportunities": quality.repeated_opportunities,
        "fk_violations": quality.fk_violations,
        "duplicate_keys": quality.duplicate_keys,
        "full_sales": lambda m: m.frame(),
        "null_counts": quality.null_counts,
        "column_catalog": quality.column_catalog,
        "distinct_counts": quality.distinct_counts,
        "string_columns": lambda m: quality.column_catalog(m, data_type="string"),
        "key_summary": key_summary,
        # exploration
        "product_numbering": explore.product_numbering,
        "team_size": explore.team_size,
        "account_count": explore.account_count,
        "accounts_by_sector": explore.accounts_by_sector,
        "accounts_by_location": explore.accounts_by_location,
        "accounts_by_holding": explore.accounts_by_holding,
        "deals_by_stage": explore.deals_by_stage,
        "date_bounds": explore.date_bounds,
        "month_of_year_sales": explore.month_of_year_sales,
        "kpi_measures": lambda m: explore.kpi_measures(m, value_type=p.kpi_type),
        **{
            f"magnitude_{d}": (lambda m, d=d: explore.magnitude(m, d))
            for d in explore.MAGNITUDE_DIMENSIONS
        },
        "magnitude_all": explore.magnitude_all,
        # ranking and shares
        "series_share": share.series_share,
        f"top{p.top_n}_agents_value": lambda m: rank.top_agents_by_value(m, n=p.top_n),
        f"top{p.top_n}_agents_win_rate": lambda m: rank.top_agents_by_win_rate(m, n=p.top_n),
        "location_share": share.location_share,
        "sector_pareto": share.sector_pareto,
        # cumulative
        "cumulative_deals_by_product": cumulative.cumulative_deals_by_product,
        "threshold_date": lambda m: cumulative.threshold_date(m, amount=p.threshold),
        "focal_agent_share": lambda m: cumulative.focal_agent_share(m, agent=p.focal_agent),
        "new_accounts_by_month": cumulative.new_accounts_by_month,
        # performance
        "agent_revenue_rank": rank.agent_revenue_rank,
        "manager_win_rate": performance.manager_win_rate,
        "sector_performance": performance.sector_performance,
        "negotiation_days": performance.negotiation_days,
        "account_win_rate": performance.account_win_rate,
        "sector_frequency": performance.sector_frequency,
        # part-to-whole
        "series_part_to_whole": share.series_part_to_whole,
        "agent_tier": lambda m: rank.agent_tier(m, tiles=p.tiles),
        "home_vs_other": lambda m: share.home_vs_other(m, home=p.home),
        "non_home_products": lambda m: share.non_home_products(m, home=p.home),
        # segmentation and report
        "agent_segment": lambda m: segment.agent_segment(m, outlier=p.focal_agent),
        "account_segment": lambda m: segment.account_segment(m, home=p.home),
        "sales_insights_view": report.sales_insights_view,
        "agent_month_insights": report.agent_month_insights,
    }


def analysis_names(params: Params) -> list[str]:
    return list(_catalog(params))


def analyses(model: CrmModel, params: Params) -> dict[str, Callable[[], DataFrame]]:
    """Every analysis of ``model``; each value builds its DataFrame when called
    (building some analyses runs a checkpoint job, so build only what you use)."""
    return {name: (lambda fn=fn: fn(model)) for name, fn in _catalog(params).items()}


# --- the star-schema test mapping ---------------------------------------------

STAR_PARAMS = Params(home=HOME_COUNTRY, focal_agent=FOCAL_AGENT, threshold=THRESHOLD, repairs=((FOCAL_AGENT, REPAIRED_AGENT),))

_MODELS: dict[tuple[str, str], CrmModel] = {}


def model_for(spark: SparkSession, sf_dir: str) -> CrmModel:
    """The star model of ``sf_dir``, built once per application and directory
    (a model holds lazy plans only; analyses share it)."""
    key = (session_key(spark), sf_dir)
    if key not in _MODELS:
        _MODELS[key] = from_star(spark, sf_dir)
    return _MODELS[key]


def _on_star(name: str, fn: Callable[[CrmModel], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(model_for(spark, sf_dir))

    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {name: _on_star(name, fn) for name, fn in _catalog(STAR_PARAMS).items()}
