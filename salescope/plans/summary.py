"""Key summaries: the deals summed once by each dimension's key and the stage.

Most analyses group the deals by labels of a single dimension.  The sums of
all measures by that dimension's key are enough for them, and have one row for
each key and stage instead of one for each deal.  :func:`write_key_summary`
makes those of all dimensions in one pass over the deals and writes them as
Parquet, partitioned by key; a model from :func:`with_key_summary` answers from
them whatever can be (breakdowns and shares by one dimension, rankings, win
rates, NULL counts, foreign-key and orphan checks), and reads the deals for
the rest.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.plans.model import FACT_COLUMNS, CrmModel


def write_key_summary(model: CrmModel, path: str, mode: str = "overwrite") -> None:
    """Write the summary of ``model`` to ``path`` (a shared folder)."""
    replace(model, summary=None).summary_rows().write.mode(mode).partitionBy("key_name").parquet(path)


def with_key_summary(spark: SparkSession, model: CrmModel, path: str) -> CrmModel:
    """``model`` with the summary at ``path``.  It must be of the same deals:
    write it anew when they change."""
    schema = replace(model, summary=None).summary_rows().schema
    return replace(model, summary=spark.read.schema(schema).parquet(path))


def key_summary(model: CrmModel) -> DataFrame:
    """``(key_name, key_value, deal_stage, deals, won_deals, revenue,
    first_close, last_close)``: the summary by the deals' own labels (agent,
    product, account), one scan of the deals."""
    rows = model.summary_rows()
    names, labels = F.col("key_name"), None
    value = F.coalesce(*[F.col(d.key).cast("string") for d in model.dims])
    for d in model.dims:
        if d.key in FACT_COLUMNS:
            continue
        label = next(c for c in d.provides if c in FACT_COLUMNS)
        names = F.when(F.col("key_name") == d.key, F.lit(label)).otherwise(names)
        part = d.frame.select(F.lit(d.key).alias("key_name"), F.col(d.key).cast("string").alias("__key"), F.col(label).cast("string").alias("__label"))
        labels = part if labels is None else labels.unionByName(part)
    rows = rows.withColumn("__key", value)
    if labels is not None:
        itself = F.col("key_name").isin([d.key for d in model.dims if d.key in FACT_COLUMNS])
        rows = rows.join(labels, ["key_name", "__key"], "left").withColumn("__key", F.when(itself, F.col("__key")).otherwise(F.col("__label")))
    return rows.groupBy(names.alias("key_name"), F.col("__key").alias("key_value"), "deal_stage").agg(
        F.sum("deals").alias("deals"),
        F.sum("won_deals").alias("won_deals"),
        F.sum("revenue").alias("revenue"),
        F.min("first_close").alias("first_close"),
        F.max("last_close").alias("last_close"),
    )
