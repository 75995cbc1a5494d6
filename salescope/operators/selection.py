"""Tiles over a global order by exact selection of the rows that end them.

``ntile`` needs no row's position, only the last row of every tile.  These few
rows are found by narrowing: a handful of rows of the interval that holds a
wanted place serve as pivots, one aggregate counts the rows between them, and
the interval between two pivots that holds the place goes on, until it is small
enough to be read in order.  A round divides an interval by about the number of
pivots, so 10 ** 9 rows take four or five aggregates.  No row is moved: there
is no range shuffle, no sort and no window, and ties are settled by the last
columns of the order like any other rows, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_KEY = "__key"


def sort_key(df: DataFrame, by: Sequence[str], ascending: Sequence[bool]) -> Column:
    """A struct whose ascending order is that of ``ORDER BY`` (ascending: NULLs
    first, descending: NULLs last) and that holds no NULL.

    Integers and decimals both ways, strings, dates and booleans ascending;
    others raise (floating sums may differ when a lost task runs again, and the
    counts of two rounds must agree).
    """
    fields = []
    for name, up in zip(by, ascending, strict=True):
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, _WHOLE):
            value = F.coalesce(c if up else F.bitwise_not(c), F.lit(0).cast(kind))
        elif isinstance(kind, T.DecimalType):
            value = F.coalesce(c if up else F.negative(c), F.lit(0).cast(kind))
        elif up and isinstance(kind, T.StringType):
            value = F.coalesce(c, F.lit(""))
        elif up and isinstance(kind, T.DateType):
            value = F.coalesce(c, F.lit("1970-01-01").cast(kind))
        elif up and isinstance(kind, T.BooleanType):
            value = F.coalesce(c, F.lit(False))
        else:
            raise ValueError(f"no exact order for {name} {kind.simpleString()}{'' if up else ' descending'}")
        fields += [(c.isNotNull() if up else c.isNull()).alias(f"n{len(fields)}"), value.alias(f"v{len(fields)}")]
    return F.struct(*fields)


def _literal(key: Row, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind.fields, strict=True)])


def rows_at(keys: DataFrame, places: Iterable[int], pivots: int = 64, few: int = 4096) -> dict[int, Row]:
    """The sort keys at the 1-based ``places`` of the order of ``keys``' column
    ``__key``.  ``few`` bounds the rows that the driver reads at once (plan
    only: any value gives the same result)."""
    kind = keys.schema[_KEY].dataType
    found: dict[int, Row] = {}
    wanted = sorted(set(places))
    # (rows before the interval, rows in it, lower bound excluded, upper bound included, places)
    open_ = [(0, None, None, None, wanted)] if wanted else []
    while open_:
        before, size, low, high, inside = open_.pop()
        rows = keys
        if low is not None:
            rows = rows.where(F.col(_KEY) > _literal(low, kind))
        if high is not None:
            rows = rows.where(F.col(_KEY) <= _literal(high, kind))
        if size is not None and size <= few:
            ordered = rows.orderBy(_KEY).collect()
            found.update({p: ordered[p - before - 1][0] for p in inside})
            continue
        chosen = rows.select(_KEY, F.xxhash64(_KEY).alias("h")).distinct().orderBy("h").limit(pivots).orderBy(_KEY)
        ends = [r[0] for r in chosen.collect()]
        if high is not None and (not ends or ends[-1] != high):
            ends.append(high)
        if size == 0 or not ends:
            continue
        below = F.size(F.filter(F.array(*[_literal(e, kind) for e in ends]), lambda e: e < F.col(_KEY)))
        counts = dict(rows.groupBy(below.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        for b in sorted(counts):
            here = [p for p in inside if before < p <= before + counts[b]]
            end = ends[b] if b < len(ends) else high
            start = ends[b - 1] if b else low
            if here and counts[b] > few and _alone(rows, start, end, kind):
                found.update(dict.fromkeys(here, end))
            elif here:
                open_.append((before, counts[b], start, end, here))
            before += counts[b]
    return found


def _alone(rows: DataFrame, low: Row | None, high: Row | None, kind: T.StructType) -> bool:
    """Whether the rows above ``low`` up to ``high`` all equal ``high``."""
    if high is None:
        return False
    other = rows.where(F.col(_KEY) < _literal(high, kind))
    if low is not None:
        other = other.where(F.col(_KEY) > _literal(low, kind))
    return other.isEmpty()


def ntile_by_selection(
    df: DataFrame,
    n: int,
    by: Sequence[str],
    ascending: Sequence[bool],
    name: str = "ntile",
    takes: Column | None = None,
    pivots: int = 64,
    few: int = 4096,
) -> DataFrame:
    """``df`` plus ``ntile(n) over (order by <by>)``; the order must be total.

    Rows that fail ``takes`` take no place; their tile means nothing.  Rows
    equal in all of ``by`` share a tile, the one of the first of them.  ``df``
    is kept (memory, then disk) so that the rounds and the result read it once;
    it has to give the same rows when a lost part is computed again, as exact
    sums do.  An empty ``df`` gives no rows.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    key = sort_key(df, by, ascending)
    level = df.storageLevel
    kept = df if level.useMemory or level.useDisk else df.persist(StorageLevel.MEMORY_AND_DISK)
    placed = kept if takes is None else kept.where(takes)
    keys = placed.select(key.alias(_KEY))
    total = keys.count()
    ends, end = [], 0
    for tile in range(n - 1):
        end += total // n + (tile < total % n)
        ends.append(end)
    at = rows_at(keys, [e for e in ends if e], pivots, few)
    kind = keys.schema[_KEY].dataType
    tile = F.lit(1)
    for e in ends:
        if e:
            tile = tile + (key > _literal(at[e], kind)).cast("int")
    return kept.withColumn(name, tile.cast("int"))
