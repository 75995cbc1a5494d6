"""salescope: sales-pipeline analytics on Spark.

A star schema of deals (fact) with sales teams, products and customer
accounts (dimensions), analysed with the DataFrame API.  Every analysis is a
function from a :class:`~salescope.plans.model.CrmModel` (or DataFrames) to a
DataFrame; nothing is collected to the driver.

Sub-packages
------------
sources     readers: CRM CSV/Parquet files, and the star-schema test mapping
plans       the data model (denormalised deal frame, join selection,
            two-level aggregation over the star) and session helpers
functions   Column helpers with T-SQL numeric semantics (no UDFs)
operators   the analyses: data quality, exploration, shares, rankings,
            cumulative, performance, segmentation, report
"""

from salescope.plans.model import FULL_SALES_COLUMNS, CrmModel, Dimension
from salescope.registry import Params, analyses
from salescope.sources import from_star, load_crm, model_from_frames

__all__ = [
    "FULL_SALES_COLUMNS",
    "CrmModel",
    "Dimension",
    "Params",
    "analyses",
    "from_star",
    "load_crm",
    "model_from_frames",
]
