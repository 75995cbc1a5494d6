"""Materialised deal frame and SQL views.

The analysed scripts copy the denormalised frame into a session temp table
before every analysis.  On Spark the frame stays lazy by default (column
pruning and join selection then apply per analysis); when many analyses run
over the same data, :func:`write_snapshot` writes it once as Parquet in a
shared folder, partitioned by deal stage, and :func:`from_snapshot` reads it
back as a model whose fact already carries every column: no dimension join
runs again, and a stage filter prunes partitions instead of scanning.

:func:`refresh_snapshot` keeps such a snapshot up to date by writing only the
partitions that changed.  Both count keys without a parent row in the pass that
reads the deals anyway.

:func:`register_views` exposes the tables, the frame and the report as temp
views for callers that prefer ``spark.sql``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salescope.plans.model import FACT_COLUMNS, FULL_SALES_COLUMNS, CrmModel


_MONTH = "close_month"


class UnmatchedKeys(ValueError):
    """Deals refer to keys that a dimension lacks; nothing was published."""

    def __init__(self, report: SnapshotReport):
        super().__init__(f"deals without a parent row: {report.unmatched}")
        self.report = report


@dataclass(frozen=True)
class SnapshotReport:
    """What the pass that wrote a snapshot saw: the rows written, and per
    dimension the rows whose key is set but has no parent row, and those whose
    key is NULL.  ``partitions``: the partitions (stage, close month) written
    or removed by a refresh, None if the whole was written."""

    rows: int
    unmatched: dict[str, int]
    null_keys: dict[str, int]
    partitions: tuple[tuple[str | None, str | None], ...] | None = None


def _frame(model: CrmModel, columns: Sequence[str]) -> DataFrame:
    """The deal frame with its dimensions' keys and a flag for each parent row."""
    keys = [d.key for d in model.dims if d.key not in columns]
    return model.frame([*columns, *dict.fromkeys(keys)], matched={d.name: f"__has_{d.name}" for d in model.dims})


def _metrics(model: CrmModel) -> list[Column]:
    sums = [F.count(F.lit(1)).alias("rows")]
    for d in model.dims:
        has = F.col(f"__has_{d.name}")
        sums.append(F.count_if(F.col(d.key).isNotNull() & ~has).alias(f"unmatched_{d.name}"))
        sums.append(F.count_if(F.col(d.key).isNull()).alias(f"null_{d.name}"))
    return sums


def _plain(model: CrmModel, df: DataFrame) -> DataFrame:
    return df.drop(*[f"__has_{d.name}" for d in model.dims])


def _report(model: CrmModel, got: Mapping[str, int], partitions=None) -> SnapshotReport:
    names = [d.name for d in model.dims]
    return SnapshotReport(
        got["rows"], {n: got[f"unmatched_{n}"] for n in names}, {n: got[f"null_{n}"] for n in names}, partitions
    )


def _filesystem(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_snapshot(
    model: CrmModel,
    path: str,
    columns: Sequence[str] = FULL_SALES_COLUMNS,
    mode: str = "overwrite",
    fail_on_unmatched: bool = False,
) -> SnapshotReport:
    """Write the deal frame to ``path`` (Parquet, partitioned by ``deal_stage``),
    with the keys that its dimensions are joined by.

    Unmatched and NULL keys are counted by the job that writes.  With
    ``fail_on_unmatched`` that job writes to a folder beside ``path``, which
    takes its place only if every key is matched; else it is removed,
    :class:`UnmatchedKeys` is raised and ``path`` stays as it was.
    """
    if fail_on_unmatched and mode != "overwrite":
        raise ValueError("fail_on_unmatched needs mode 'overwrite'")
    df = _frame(model, columns)
    spark, seen = df.sparkSession, Observation(f"snapshot-{uuid.uuid4().hex}")
    target = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}" if fail_on_unmatched else path
    _plain(model, df.observe(seen, *_metrics(model))).write.mode(mode).partitionBy("deal_stage").parquet(target)
    report = _report(model, seen.get)
    if fail_on_unmatched:
        fs, staged = _filesystem(spark, target)
        if any(report.unmatched.values()):
            fs.delete(staged, True)
            raise UnmatchedKeys(report)
        _, final = _filesystem(spark, path)
        fs.delete(final, True)
        fs.rename(staged, final)
    return report


def _checksums(df: DataFrame, extra: Sequence[Column]) -> DataFrame:
    """``(deal_stage, close_month, n_rows, checksum, extra...)``: the rows of
    each partition whatever their order; NULLs are part of the sum."""
    names = [c for c in df.columns if not c.startswith("__has_") and c != _MONTH]
    row = F.xxhash64(*names, *[F.col(c).isNull() for c in names]).cast("decimal(38,0)")
    return df.groupBy("deal_stage", _MONTH).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row).alias("checksum"), *extra)


def refresh_snapshot(
    model: CrmModel,
    path: str,
    columns: Sequence[str] = FULL_SALES_COLUMNS,
    fail_on_unmatched: bool = False,
) -> SnapshotReport:
    """Bring the snapshot at ``path`` up to the model, writing only the
    partitions (stage, close month) whose rows changed.

    One pass sums every partition of the deal frame up to a row count and a
    checksum and counts the keys without a parent row; what differs from the
    manifest beside the data (``<path>.manifest``, one row a partition, so
    as many as stages times months) is written again by dynamic partition
    overwrite, and partitions without rows are removed.  The manifest is
    written last: after a run that was cut off, the next one finds the
    partitions it touched different, or no manifest, and mends them.
    ``REBALANCE`` gives a partition few files and splits a large month.  No
    manifest (a new path): everything is written.  Unmatched keys with
    ``fail_on_unmatched``: :class:`UnmatchedKeys`, before anything is written.
    """
    path = path.rstrip("/")
    df = _frame(model, columns).withColumn(_MONTH, F.date_format("close_date", "yyyy-MM"))
    spark = df.sparkSession
    fs, manifest = _filesystem(spark, f"{path}.manifest")
    known = fs.exists(manifest) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(manifest, "_SUCCESS"))
    sums = _checksums(df, [m.alias(f"m_{i}") for i, m in enumerate(_metrics(model))]).collect()
    names = ["rows", *[n for d in model.dims for n in (f"unmatched_{d.name}", f"null_{d.name}")]]
    got = {n: sum(r[f"m_{i}"] for r in sums) for i, n in enumerate(names)}
    now = {(r.deal_stage, r[_MONTH]): (r.n_rows, r.checksum) for r in sums}
    before = {}
    if known:
        before = {(r.deal_stage, r[_MONTH]): (r.n_rows, r.checksum) for r in spark.read.parquet(f"{path}.manifest").collect()}
    changed = sorted((k for k in now.keys() | before.keys() if now.get(k) != before.get(k)), key=repr)
    report = _report(model, got, tuple(changed))
    if fail_on_unmatched and any(report.unmatched.values()):
        raise UnmatchedKeys(report)
    if not known:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    elif not changed:
        return report
    else:
        fs.delete(manifest, True)
    written = df
    if known:
        written = df.where(reduce(or_, [_in_partition(*k) for k in changed if k in now], F.lit(False)))
    rebalanced = _plain(model, written).hint("rebalance", "deal_stage", _MONTH)
    rebalanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("deal_stage", _MONTH).parquet(path)
    for stage, month in changed:
        if (stage, month) not in now:
            named = [f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in (("deal_stage", stage), (_MONTH, month))]
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *named])), True)
    rows = [(*k, *v) for k, v in sorted(now.items(), key=repr)]
    stored = spark.createDataFrame(rows, f"deal_stage string, {_MONTH} string, n_rows long, checksum decimal(38,0)")
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}.manifest")
    return report


def _in_partition(stage: str | None, month: str | None) -> Column:
    """The rows of a partition, by ranges that reach the scan."""
    here = F.col("deal_stage").eqNullSafe(F.lit(stage))
    if month is None:
        return here & F.col("close_date").isNull()
    first = F.lit(f"{month}-01").cast("date")
    return here & (F.col("close_date") >= first) & (F.col("close_date") < F.add_months(first, 1))


def from_snapshot(spark: SparkSession, path: str, dims_from: CrmModel) -> CrmModel:
    """Model over a snapshot; dimension tables (for the dimension analyses)
    come from ``dims_from``."""
    snap = spark.read.parquet(path).drop(_MONTH)

    def fact(stages: tuple[str, ...] | None) -> DataFrame:
        return snap if stages is None else snap.where(F.col("deal_stage").isin(list(stages)))

    return CrmModel(fact_builder=fact, dims=dims_from.dims)


def register_views(model: CrmModel, prefix: str = "") -> list[str]:
    """Register ``sales``, each dimension, ``full_sales_data`` and
    the two reports (by agent-month, and by product too) as temp views; returns
    the names."""
    from salescope.operators.report import agent_month_insights, sales_insights_view

    views = {
        "sales": model.sales(FACT_COLUMNS),
        **{d.name: model.table(d.name) for d in model.dims},
        "full_sales_data": model.frame(),
        "sales_insights": agent_month_insights(model),
        "sales_insights_by_product": sales_insights_view(model, strategy="window"),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
