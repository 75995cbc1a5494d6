"""The CRM star schema as a lazily joined model.

The analysed workload works on one denormalised deal frame: the fact
``sales`` left-joined to ``teams``, ``products`` and ``accounts`` (18
columns).  Building that frame eagerly would join every dimension for every
analysis, and Spark cannot drop an unused left join (it knows nothing about
key uniqueness).  :class:`CrmModel` therefore builds the frame *per request*:
only the dimensions that supply a requested column are joined.

:meth:`CrmModel.measures` goes one step further for grouped analyses: it
aggregates the fact by the dimension keys first and joins the (much smaller)
aggregate to the dimensions, then re-aggregates by the requested labels.
Sums, counts, minima and maxima distribute over that split, so the result is
the same as aggregating the joined frame, including NULL keys (kept by the
left join) and duplicate dimension keys (fan-out multiplies both ways).  At
scale this keeps the billions of fact rows out of the dimension joins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The deal stages of the pipeline, and the column order of the
# denormalised deal frame.
STAGES = ("Prospecting", "Engaging", "Won", "Lost")
CLOSED_STAGES = ("Won", "Lost")
WON = "Won"

FACT_COLUMNS = (
    "opportunity_id",
    "sales_agent",
    "product",
    "account",
    "deal_stage",
    "engage_date",
    "close_date",
    "close_value",
)

FULL_SALES_COLUMNS = (
    "opportunity_id",
    "sales_agent",
    "manager",
    "regional_office",
    "product",
    "series",
    "sales_price",
    "account",
    "sector",
    "year_established",
    "revenue",
    "employees",
    "office_location",
    "subsidiary_of",
    "deal_stage",
    "engage_date",
    "close_date",
    "close_value",
)


@dataclass(frozen=True, eq=False)
class Dimension:
    """One dimension of the star.

    ``key`` is the join column; it has the same name in the fact frame and in
    ``frame``.  ``provides`` are the deal-frame columns this dimension supplies,
    ``table_columns`` the columns of the dimension as a table of its own.
    How it is joined is left to the planner's size statistics and AQE.
    """

    name: str
    frame: DataFrame
    key: str
    provides: tuple[str, ...]
    table_columns: tuple[str, ...]


# Measures over deals.  Each has a per-row expression aggregated at the first
# level and the function that merges first-level results at the second.
def _days() -> Column:
    return F.datediff(F.col("close_date"), F.col("engage_date"))


_MEASURES: dict[str, tuple[Callable[[], Column], Callable[[str], Column]]] = {
    "deals": (lambda: F.count(F.lit(1)), lambda c: F.sum(c)),
    "won_deals": (lambda: F.count_if(F.col("deal_stage") == WON), lambda c: F.sum(c)),
    "revenue": (lambda: F.sum("close_value"), lambda c: F.sum(c)),
    "valued_deals": (lambda: F.count("close_value"), lambda c: F.sum(c)),
    "nego_days": (lambda: F.sum(_days()), lambda c: F.sum(c)),
    "nego_deals": (lambda: F.count(_days()), lambda c: F.sum(c)),
    "first_close": (lambda: F.min("close_date"), lambda c: F.min(c)),
    "last_close": (lambda: F.max("close_date"), lambda c: F.max(c)),
}
MEASURES = tuple(_MEASURES)


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def by_single_key(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column] = ()) -> DataFrame:
    """``(key_name, key_value, aggregates...)``: ``df`` grouped by each of
    ``keys`` alone, in one scan (GROUPING SETS)."""
    grouped = df.groupingSets([[k] for k in keys], *keys).agg(*aggregates, F.grouping_id(*keys).alias("__gid"))
    name = F.lit(None).cast("string")
    for i, k in enumerate(keys):
        name = F.when(F.col("__gid") == (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)), F.lit(k)).otherwise(name)
    value = F.coalesce(*[F.col(k).cast("string") for k in keys])
    return grouped.withColumns({"key_name": name, "key_value": value}).drop("__gid", *keys)


def distinct_values(df: DataFrame, columns: Sequence[str], words: Sequence[str] = ()) -> DataFrame:
    """``(key_name, key_value, n_values)``: the distinct non-NULL values of each
    of ``columns``, in one scan.

    Those of ``words`` that are integers or dates are grouped by words of 64
    neighbouring values, as a bitmap of the values that occur: ``key_value`` is
    then the number of the word and ``n_values`` the number of its values (1
    elsewhere).  However thin the values lie, there are never more rows than
    values.  A row becomes one narrow row per column, combined in its task.
    """
    kinds, entries = dict(df.dtypes), []
    text, one = F.lit(None).cast("string"), F.lit(1).cast("bigint")
    for i, c in enumerate(columns):
        number = F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) if kinds[c] == "date" else F.col(c)
        number = number.cast("bigint")
        if c in words and kinds[c] in (*_WHOLE, "date"):
            entry = (F.shiftright(number, 6), text, F.call_function("shiftleft", one, number.bitwiseAND(63).cast("int")))
        elif kinds[c] in _WHOLE:
            entry = (number, text, one)
        else:
            entry = (F.lit(None).cast("bigint"), F.col(c).cast("string"), one)
        entries.append(F.struct(F.lit(i).alias("at"), *[e.alias(n) for e, n in zip(entry, ("num", "txt", "bit"), strict=True)]))
    rows = df.select(F.inline(F.array(*entries))).where("num is not null or txt is not null")
    found = rows.groupBy("at", "num", "txt").agg(F.bit_count(F.bit_or("bit")).alias("n_values"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("at") + 1)
    return found.select(name.alias("key_name"), F.coalesce(F.col("num").cast("string"), "txt").alias("key_value"), "n_values")


def merged(rows: DataFrame, by: Sequence[str], which: Sequence[str]) -> DataFrame:
    """Measures summed up anew by ``by``."""
    return rows.groupBy(*by).agg(*[_MEASURES[m][1](m).alias(m) for m in which])


@dataclass(frozen=True, eq=False)
class CrmModel:
    """Fact builder plus dimensions.

    ``fact_builder(stages)`` returns the fact frame restricted to the given deal
    stages (``None`` = all).  Sources push that restriction down to their scan
    (e.g. a raw status column), which a filter on a derived stage column would
    not reach.
    """

    fact_builder: Callable[[tuple[str, ...] | None], DataFrame]
    dims: tuple[Dimension, ...]
    #: Sums by single key and stage that stand in for the deals where they can
    #: (see :mod:`salescope.plans.summary`).
    summary: DataFrame | None = None

    # -- tables -------------------------------------------------------------
    def fact(self, stages: Sequence[str] | None = None) -> DataFrame:
        return self.fact_builder(tuple(stages) if stages is not None else None)

    def dim(self, name: str) -> Dimension:
        for d in self.dims:
            if d.name == name:
                return d
        raise KeyError(f"unknown dimension {name!r}; have {[d.name for d in self.dims]}")

    def table(self, name: str) -> DataFrame:
        """A dimension as its own table (``teams``, ``products``, ``accounts``)."""
        d = self.dim(name)
        return d.frame.select(*d.table_columns)

    def sales(self, columns: Sequence[str] = FACT_COLUMNS, stages: Sequence[str] | None = None) -> DataFrame:
        """The fact table in its own shape (labels resolved where a source keys by surrogate)."""
        bad = [c for c in columns if c not in FACT_COLUMNS]
        if bad:
            raise ValueError(f"not fact columns: {bad}")
        return self.frame(columns, stages)

    def _supplier_of(self, column: str, fact_columns: set[str]) -> Dimension | None:
        if column in fact_columns:
            return None
        for d in self.dims:
            if column in d.provides:
                return d
        raise ValueError(f"unknown column {column!r}; expected one of {FULL_SALES_COLUMNS}")

    def with_label_flag(self, df: DataFrame, column: str, value: object, name: str) -> DataFrame:
        """``df`` (fact columns) plus a boolean ``name``: ``<column> = value`` on
        the deal frame, where ``column`` may be a label held by a dimension
        (an agent name when the fact carries the agent key).

        The dimension keys carrying that label are joined to the fact; the
        planner's statistics and AQE pick the join.  NULL and unmatched keys
        are never equal, as in the join of the deal frame.
        """
        if column in df.columns:
            return df.withColumn(name, F.coalesce(F.col(column) == F.lit(value), F.lit(False)))
        d = self._supplier_of(column, set(df.columns))
        hits = d.frame.where(F.col(column) == F.lit(value)).select(d.key).distinct().withColumn("__hit", F.lit(True))
        return (
            df.join(hits, on=d.key, how="left")
            .withColumn(name, F.coalesce(F.col("__hit"), F.lit(False)))
            .drop("__hit")
        )

    def where_label(self, df: DataFrame, column: str, keep: Callable[[Column], Column]) -> DataFrame:
        """Rows of ``df`` (fact columns) whose label ``column`` satisfies
        ``keep``; NULL and unmatched labels don't.  Only the keys of the
        labels that do are joined, so the deals are neither widened nor
        grouped for it."""
        d = self._supplier_of(column, set(df.columns))
        if d is None:
            return df.where(keep(F.col(column)))
        return df.join(d.frame.where(keep(F.col(column))).select(d.key), on=d.key, how="inner")

    # -- denormalised frame -------------------------------------------------
    def frame(
        self,
        columns: Sequence[str] = FULL_SALES_COLUMNS,
        stages: Sequence[str] | None = None,
        matched: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Deal frame with ``columns``, joining only the dimensions they need.
        ``matched``: dimension -> name of a boolean column, whether the deal's
        key has a row there."""
        matched = dict(matched or {})
        columns = list(columns)
        fact = self.fact(stages)
        fact_columns = set(fact.columns)
        wanted: dict[str, list[str]] = {}
        for c in columns:
            d = self._supplier_of(c, fact_columns)
            if d is not None:
                wanted.setdefault(d.name, []).append(c)
        out = fact
        for d in self.dims:
            if d.name in wanted or d.name in matched:
                side = self._dim_side(d, wanted.get(d.name, []))
                if d.name in matched:
                    side = side.withColumn(matched[d.name], F.lit(True))
                out = out.join(side, on=d.key, how="left")
        return out.select(*columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in matched.values()])

    @staticmethod
    def _dim_side(d: Dimension, columns: Sequence[str]) -> DataFrame:
        return d.frame.select(d.key, *[c for c in columns if c != d.key])

    # -- sums by single keys --------------------------------------------------
    def _summed(self, names: Sequence[str], stages: Sequence[str] | None) -> DataFrame | None:
        """The summary's rows for a grouping by ``names``; None if it has none
        (a key of its own, the stage, or both)."""
        if self.summary is None or not names:
            return None
        keys = [n for n in names if n != "deal_stage"] or [self.dims[0].key]
        if len(keys) > 1 or keys[0] not in [d.key for d in self.dims]:
            return None
        rows = self.summary.where(F.col("key_name") == keys[0])
        return rows if stages is None else rows.where(F.col("deal_stage").isin(list(stages)))

    def fact_keys(self, key: str, stages: Sequence[str] | None = None) -> DataFrame:
        """The distinct values of one key of the deals."""
        rows = self._summed([key], stages)
        return (self.fact(stages) if rows is None else rows).select(key).distinct()

    def by_key(
        self,
        columns: Sequence[str],
        which: Sequence[str] = (),
        stages: Sequence[str] | None = None,
        nulls: Sequence[str] = (),
    ) -> tuple[DataFrame, dict[str, tuple[Dimension | None, list[str]]]]:
        """The deals summed by each key that ``columns`` hang on, in one scan
        (GROUPING SETS): ``(key_name, key_value, measures...)``, and per key its
        dimension (None: the fact itself) and the columns it leads to.
        ``nulls``: fact columns whose NULLs are counted as ``null_<column>``."""
        fact = self.fact(stages)
        sources = self._sources(columns)
        stored = [self._summed([k], stages) for k in sources]
        if all(rows is not None for rows in stored):
            value = F.coalesce(*[F.col(k).cast("string") for k in sources]).alias("key_value")
            sums = [*[_MEASURES[m][1](m).alias(m) for m in which], *[F.sum(f"null_{c}").alias(f"null_{c}") for c in nulls]]
            rows = self.summary.where(F.col("key_name").isin(list(sources)))
            rows = rows if stages is None else rows.where(F.col("deal_stage").isin(list(stages)))
            return rows.groupBy("key_name", value).agg(F.lit(None).alias("__none"), *sums).drop("__none"), sources
        counted = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls]
        return by_single_key(fact, list(sources), [*[_MEASURES[m][0]().alias(m) for m in which], *counted]), sources

    def _sources(self, columns: Sequence[str]) -> dict[str, tuple[Dimension | None, list[str]]]:
        """The keys that ``columns`` hang on, with their dimensions."""
        sources: dict[str, tuple[Dimension | None, list[str]]] = {}
        own = set(self.fact().columns)
        for c in columns:
            d = self._supplier_of(c, own)
            sources.setdefault(c if d is None else d.key, (d, []))[1].append(c)
        for d in self.dims:  # a key asked for by name may lead to labels too
            if d.key in sources and sources[d.key][0] is None:
                sources[d.key] = (d, sources[d.key][1])
        return sources

    def distinct_by_key(self, columns: Sequence[str]) -> tuple[DataFrame, dict[str, tuple[Dimension | None, list[str]]]]:
        """:func:`distinct_values` of the keys that ``columns`` hang on, in one
        scan; keys that lead to nothing but themselves as bitmaps."""
        sources = self._sources(columns)
        return distinct_values(self.fact(), list(sources), [k for k, (_, names) in sources.items() if names == [k]]), sources

    def summary_rows(self) -> DataFrame:
        """Every measure and the NULL counts of the fact's columns by each
        dimension's key and the stage: ``(key_name, keys..., deal_stage,
        measures..., null_<column>...)``, one row per key and stage, in one
        scan of the deals; all but the row's own key are NULL."""
        if self.summary is not None:
            return self.summary
        fact, keys = self.fact(), list(dict.fromkeys(d.key for d in self.dims))
        sums = [_MEASURES[m][0]().alias(m) for m in MEASURES]
        sums += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in fact.columns]
        sets = [[k, "deal_stage"] for k in keys]
        grouped = fact.groupingSets(sets, *keys, "deal_stage").agg(*sums, F.grouping_id(*keys, "deal_stage").alias("__gid"))
        name = F.lit(None).cast("string")
        for i, k in enumerate(keys):
            gid = sum(1 << (len(keys) - j) for j in range(len(keys)) if j != i)
            name = F.when(F.col("__gid") == gid, F.lit(k)).otherwise(name)
        return grouped.withColumn("key_name", name).drop("__gid")

    # -- two-level aggregation ----------------------------------------------
    def measures(
        self,
        by: Sequence[str],
        which: Sequence[str] = ("deals", "revenue"),
        stages: Sequence[str] | None = None,
        derived: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Deal measures grouped by ``by`` (deal-frame columns or ``derived`` names).

        ``derived`` maps new names to expressions over fact columns (e.g. the
        close month); they are computed before the first aggregation.
        Output: the ``by`` columns, then one column per measure in ``which``.
        """
        rows, done = self._labelled(by, which, stages, derived)
        return rows if done else merged(rows, by, which)

    def _labelled(
        self,
        by: Sequence[str],
        which: Sequence[str],
        stages: Sequence[str] | None,
        derived: Mapping[str, Column] | None,
    ) -> tuple[DataFrame, bool]:
        """The measures by key with the labels of ``by``, and whether they are
        final: without a dimension there is one row for each group."""
        derived = dict(derived or {})
        unknown = [m for m in which if m not in _MEASURES]
        if unknown:
            raise ValueError(f"unknown measures {unknown}; have {MEASURES}")
        fact = self.fact(stages)
        fact_columns = set(fact.columns)
        by = list(by)
        dims: list[Dimension] = []
        for c in by:
            if c in derived:
                continue
            d = self._supplier_of(c, fact_columns)
            if d is not None and all(d.name != seen.name for seen in dims):
                dims.append(d)

        first_keys: list[Column] = []
        first_names: list[str] = []
        for c in by:
            if c in derived:
                first_keys.append(derived[c].alias(c))
                first_names.append(c)
            elif c in fact_columns:
                first_keys.append(F.col(c))
                first_names.append(c)
        for d in dims:
            if d.key not in first_names:
                first_keys.append(F.col(d.key))
                first_names.append(d.key)

        stored = None if any(c in derived for c in by) else self._summed(first_names, stages)
        if stored is not None:
            partial = stored.groupBy(*first_names).agg(*[_MEASURES[m][1](m).alias(m) for m in which])
        else:
            partial = fact.groupBy(*first_keys).agg(*[_MEASURES[m][0]().alias(m) for m in which])
        if not dims:
            return partial.select(*by, *which), True
        joined = partial
        for d in dims:
            needed = [c for c in by if c in d.provides and c not in first_names]
            joined = joined.join(self._dim_side(d, needed), on=d.key, how="left")
        return joined.select(*by, *which), False
