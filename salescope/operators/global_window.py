"""Row number, rank and ntile over a *global* order, without a
single-partition window.

``rank().over(Window.orderBy(...))`` has no partition key, so Spark moves
every row to one task (``Exchange SinglePartition``).  That is fine for a
handful of sectors or months, not for millions of agents, accounts or
products.  Here the order is computed in parallel:

1. ``repartitionByRange`` on the order (sampled bounds, so each partition
   holds a contiguous slice of the order) and tag each row with
   ``spark_partition_id()``;
2. ``checkpoint()`` the tagged frame to the reliable checkpoint directory: the
   range bounds come from a sample, so a recomputation after a lost executor
   could assign rows differently; the checkpoint pins one assignment;
3. per-partition totals (one row per partition) -> exclusive prefix sums over
   that tiny frame -> broadcast (its size is the partition count);
4. the local number: for plain row numbers the partition is sorted and a
   row's ``monotonically_increasing_id`` less the partition base is its
   index, computed before the checkpoint (no further shuffle); for weighted
   positions a window *partitioned by the partition id*.  The global position
   is the partition offset plus the local number.

Running sums and ``lag`` inside groups (:func:`running_within`) use the same
range-partitioned checkpoint with the group columns leading the order: windows
run per (partition, group), and a group that continues from earlier
partitions gets their sums and last value from per-partition statistics.

``rank`` uses the same checkpoint: the place of a run of ties is that of its
first row, carried over partition borders by per-partition statistics.
``ntile`` maps the global position to a tile with the total row count.

Positions and ranks are ``bigint`` (a global order over billions of rows
does not fit ``int``); tiles are ``int``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.kpi import int_div
from salescope.plans.session import ensure_checkpoint_dir

_PID = "__pid"
_POS = "__pos"
_OFFSET = "__offset"
_TOTAL = "__total"
_PART = "__part"
_W = "__weight"
_LOCAL = "__local"


def _range_checkpoint(df: DataFrame, order: Sequence[Column], partitions: int | None, local_index: bool) -> DataFrame:
    """Range-partition ``df`` on ``order``, tag rows with their partition id
    (and, when ``local_index``, their index in the sorted partition), and
    checkpoint.

    A reliable checkpoint runs its input twice (once for the job, once to
    write the files) and the range bounds need a sampling pass: the input is
    persisted meanwhile so that it is computed once; the write reuses the
    shuffle output.  The cache is dropped once the checkpoint is written.
    """
    ensure_checkpoint_dir(df.sparkSession)
    level = df.storageLevel
    cached_by_caller = level.useMemory or level.useDisk
    source = df if cached_by_caller else df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Without an explicit count AQE may coalesce the range partitions; they
        # stay contiguous slices of the order, which is all the numbering needs.
        ranged = source.repartitionByRange(partitions, *order) if partitions else source.repartitionByRange(*order)
        if local_index:
            ranged = ranged.sortWithinPartitions(*order)
        tagged = ranged.withColumn(_PID, F.spark_partition_id())
        if local_index:
            # sorted inside its partition, a row's local index is its
            # monotonically_increasing_id less the partition base (index << 33)
            tagged = tagged.withColumn(
                _LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33)
            )
        return tagged.checkpoint(eager=True)
    finally:
        if not cached_by_caller:  # leave a cache the caller made alone
            source.unpersist()


def _positions(df: DataFrame, order: Sequence[Column], weight: str | None, partitions: int | None) -> DataFrame:
    """``df`` plus ``__pos`` (inclusive running count, or running sum of
    ``weight``, in the global ``order``) and ``__total`` (grand total)."""
    plain = weight is None
    tagged = _range_checkpoint(df, order, partitions, local_index=plain)
    w = F.lit(1).cast("long") if plain else F.col(weight).cast("long")
    per_part = tagged.groupBy(_PID).agg(F.sum(w).alias(_PART))
    prefix = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_part.select(
        _PID,
        (F.sum(_PART).over(prefix) - F.col(_PART)).alias(_OFFSET),
        F.sum(_PART).over(Window.partitionBy()).alias(_TOTAL),
    )
    if plain:
        local = F.col(_LOCAL) + 1
    else:
        running = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = F.sum(w).over(running)
    return (
        tagged.join(F.broadcast(offsets), _PID)
        .withColumn(_POS, F.col(_OFFSET) + local)
        .drop(_PID, _LOCAL, _OFFSET)
    )


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "row_number", partitions: int | None = None
) -> DataFrame:
    """``row_number() over (order by <order>)``; ``order`` should be total."""
    return _positions(df, order, None, partitions).withColumn(name, F.col(_POS).cast("long")).drop(_POS, _TOTAL)


def _sort(columns: Sequence[str], ascending: Sequence[bool]) -> list[Column]:
    return [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(columns, ascending, strict=True)]


def global_rank(
    df: DataFrame,
    by: Sequence[str],
    ascending: Sequence[bool],
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """``rank() over (order by <by>)``: ties share a rank, gaps follow.

    ``df`` is read once.  The other columns break ties in the range order, so
    a value held by many rows is spread over partitions; a run of ties that
    continues from earlier partitions takes its first place from one row of
    statistics per partition.
    """
    by = list(by)
    rest = [F.col(c).asc() for c in df.columns if c not in by]
    tagged = _range_checkpoint(df, [*_sort(by, ascending), *rest], partitions, local_index=True)
    value = F.struct(*[F.col(c) for c in by])
    # per partition: its first value, and its last with the place it starts at
    groups = tagged.groupBy(_PID, *by).agg(F.min(_LOCAL).alias("__lo"), F.count(F.lit(1)).alias(_W))
    stats = groups.groupBy(_PID).agg(
        F.min_by(value, "__lo").alias("__fk"),
        F.max_by(F.struct(value.alias("k"), F.col("__lo").alias("lo")), "__lo").alias("__last"),
        F.sum(_W).alias(_PART),
    )
    by_pid = Window.orderBy(_PID)
    prefix = by_pid.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stats = stats.withColumn(_OFFSET, F.sum(_PART).over(prefix) - F.col(_PART))
    # a run of ties starts in the first of the partitions that end in it
    start = F.min(F.col(_OFFSET) + F.col("__last.lo")).over(Window.partitionBy(F.col("__last.k")))
    stats = stats.withColumn("__start", start)
    goes_on = F.col("__fk").eqNullSafe(F.lag("__last.k").over(by_pid)) & F.lag(_PID).over(by_pid).isNotNull()
    carries = stats.select(_PID, _OFFSET, "__fk", F.when(goes_on, F.lag("__start").over(by_pid)).alias("__carry"))
    first = F.min(_LOCAL).over(Window.partitionBy(_PID, *by))
    out = tagged.withColumn("__lo", first).join(F.broadcast(carries), _PID)
    carried = F.when(value.eqNullSafe(F.col("__fk")), F.col("__carry"))
    rank = F.coalesce(carried, F.col(_OFFSET) + F.col("__lo")) + 1
    return out.withColumn(name, rank.cast("long")).drop(_PID, _LOCAL, "__lo", "__fk", "__carry", _OFFSET)


def ntile_of(position: Column, total: Column, n: int) -> Column:
    """Tile (1..n) of a 1-based ``position`` among ``total`` rows.

    With ``b = total div n`` and ``r = total mod n`` the first ``r`` tiles hold
    ``b + 1`` rows and the others ``b``.
    """
    p = position - 1
    b = int_div(total, F.lit(n))
    r = total % n
    big = r * (b + 1)
    return (
        F.when(p < big, int_div(p, b + 1) + 1)
        .otherwise(r + int_div(p - big, b) + 1)
        .cast("int")
    )


def global_ntile(
    df: DataFrame, n: int, order: Sequence[Column], name: str = "ntile", partitions: int | None = None, weight: str | None = None
) -> DataFrame:
    """``ntile(n) over (order by <order>)``; ``order`` should be total.  Rows
    whose ``weight`` (0 or 1) is 0 take no place; their tile means nothing."""
    pos = _positions(df, order, weight, partitions)
    return pos.withColumn(name, ntile_of(F.col(_POS), F.col(_TOTAL), n)).drop(_POS, _TOTAL)


def row_number_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order: Sequence[Column],
    name: str = "row_number",
    partitions: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by <partition_by> order by <order>)``:
    a running count inside each group (see :func:`running_within`), so a group
    holding most rows is spread over many tasks instead of one window
    partition."""
    counted = running_within(
        df.withColumn("__one", F.lit(1).cast("long")), partition_by, order, sums={name: "__one"}, partitions=partitions
    )
    return counted.drop("__one")


def running_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, str],
    lags: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Running sums and previous-row values inside groups, without one window
    partition per group.

    ``sums``: output name -> column; ``SUM(column) OVER (PARTITION BY
    <partition_by> ORDER BY <order> ROWS UNBOUNDED PRECEDING)`` (NULL until the
    first non-NULL value).  ``lags``: output name -> column; ``LAG(column)``
    over the same order.  ``order`` should be total inside a group.

    The rows are range-partitioned on (group, order) and checkpointed, so a
    group holding a third of all rows spans many partitions.  Windows run per
    (partition, group); a group that continues from earlier partitions gets
    their sums and the previous partition's last value from per-partition
    statistics (one row per partition, broadcast back).
    """
    keys = list(partition_by)
    lags = dict(lags or {})
    full = [F.col(k).asc() for k in keys] + list(order)
    tagged = _range_checkpoint(df, full, partitions, local_index=True)

    # windows inside (partition, group), in the sorted order (= local index)
    w = Window.partitionBy(_PID, *keys).orderBy(_LOCAL)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value_cols = sorted(set(sums.values()))
    local = tagged
    for c in value_cols:
        local = local.withColumn(f"__ls_{c}", F.sum(F.coalesce(F.col(c), F.lit(0))).over(run))
        local = local.withColumn(f"__ln_{c}", F.count(F.col(c)).over(run))
    for name, c in lags.items():
        local = local.withColumn(f"__ll_{name}", F.lag(F.col(c)).over(w))
    local = local.withColumn("__first", F.row_number().over(w) == 1)

    # per partition, from the checkpointed rows (no shuffle of the rows: one
    # partial aggregate by (partition, group), then one by partition): the
    # first group, and the last group with its sums and last values
    group = F.struct(*[F.col(k) for k in keys])
    per_group = tagged.groupBy(_PID, *keys).agg(
        F.min(_LOCAL).alias("__lo"),
        F.max(_LOCAL).alias("__hi"),
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__ts_{c}") for c in value_cols],
        *[F.count(F.col(c)).alias(f"__tn_{c}") for c in value_cols],
        *[F.max_by(F.col(c), F.col(_LOCAL)).alias(f"__tv_{name}") for name, c in lags.items()],
    )
    last_group = F.struct(
        group.alias("k"),
        *[F.col(f"__ts_{c}").alias(f"s_{c}") for c in value_cols],
        *[F.col(f"__tn_{c}").alias(f"n_{c}") for c in value_cols],
        *[F.col(f"__tv_{name}").alias(f"v_{name}") for name in lags],
    )
    stats = per_group.groupBy(_PID).agg(
        F.min_by(group, F.col("__lo")).alias("__fk"), F.max_by(last_group, F.col("__hi")).alias("__last")
    )
    # sums of a group over all partitions so far that end in it
    by_last = Window.partitionBy(F.col("__last.k")).orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stats = stats.select(
        _PID,
        "__fk",
        "__last",
        *[F.sum(F.col(f"__last.s_{c}")).over(by_last).alias(f"__is_{c}") for c in value_cols],
        *[F.sum(F.col(f"__last.n_{c}")).over(by_last).alias(f"__in_{c}") for c in value_cols],
    )
    by_pid = Window.orderBy(_PID)
    carries = stats.select(
        _PID,
        "__fk",
        F.coalesce(F.col("__fk").eqNullSafe(F.lag(F.col("__last.k")).over(by_pid)), F.lit(False)).alias("__cont"),
        *[F.lag(f"__is_{c}").over(by_pid).alias(f"__cs_{c}") for c in value_cols],
        *[F.lag(f"__in_{c}").over(by_pid).alias(f"__cn_{c}") for c in value_cols],
        *[F.lag(F.col(f"__last.v_{name}")).over(by_pid).alias(f"__cv_{name}") for name in lags],
    )

    out = local.join(F.broadcast(carries), _PID)
    continued = group.eqNullSafe(F.col("__fk")) & F.col("__cont")
    for name, c in sums.items():
        total = F.col(f"__ls_{c}") + F.when(continued, F.col(f"__cs_{c}")).otherwise(F.lit(0))
        count = F.col(f"__ln_{c}") + F.when(continued, F.col(f"__cn_{c}")).otherwise(F.lit(0))
        out = out.withColumn(name, F.when(count > 0, total))
    for name in lags:
        carried = F.when(continued, F.col(f"__cv_{name}"))
        out = out.withColumn(name, F.when(F.col("__first"), carried).otherwise(F.col(f"__ll_{name}")))
    helper = [_PID, _LOCAL, "__first", "__fk", "__cont"]
    for c in value_cols:
        helper += [f"__ls_{c}", f"__ln_{c}", f"__cs_{c}", f"__cn_{c}"]
    for name in lags:
        helper += [f"__ll_{name}", f"__cv_{name}"]
    return out.drop(*helper)
