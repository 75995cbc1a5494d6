"""Data quality: orphan keys, value repair, foreign-key checks, NULL profile,
column catalog.

Foreign keys cannot be declared in Spark; they are checked as jobs.  Each
check aggregates the fact by key *before* the anti join, so the join sees one
row per distinct key instead of every deal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.plans.model import FACT_COLUMNS, FULL_SALES_COLUMNS, WON, CrmModel, by_single_key


def orphans(rows: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``rows`` whose ``key`` has no ``dim`` row (NULL keys included).

    A NULL key never matches, so it is reported, as a ``LEFT JOIN ... IS NULL``
    reports it.  Pass distinct or aggregated keys: the anti join then sees one
    row per key.
    """
    dim_key = dim_key or key
    parents = dim.select(F.col(dim_key).alias("__parent"))
    return rows.join(parents, rows[key] == parents["__parent"], "left_anti")


def orphan_products(model: CrmModel) -> DataFrame:
    """Distinct products of the fact that the products table does not know."""
    d = model.dim("products")
    return orphans(model.fact_keys(d.key), d.frame, d.key)


def repair_values(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str] | DataFrame | None = None,
    canonical: DataFrame | None = None,
    canonical_column: str | None = None,
) -> DataFrame:
    """Rewrite known bad values of ``column``; same schema as ``df``.

    ``mapping``: pairs of a bad and a good value, as a dict or as a table of
    two columns of any size (joined; the smallest good value of a bad one that
    is listed twice).
    ``canonical``: a table of correct spellings.  A value that equals one
    stays; another is replaced by the spelling it equals after trimming and
    lower-casing, if there is just one such spelling.
    """
    out = df
    cols = df.columns
    if mapping is not None:
        if isinstance(mapping, Mapping):
            mapping = df.sparkSession.createDataFrame([*mapping.items()], "bad string, good string")
        bad, good = (F.col(c) for c in mapping.columns)
        pairs = mapping.groupBy(bad.alias("__bad")).agg(F.min(good).alias("__new"))
        out = out.join(pairs, out[column] == pairs["__bad"], "left")
        out = out.withColumn(column, F.coalesce(F.col("__new"), F.col(column))).select(*cols)
    if canonical is not None:
        ccol = canonical_column or column
        norm = lambda c: F.lower(F.trim(c))
        # an ambiguous spelling, of which a correct value may be one, stays
        spellings = (
            canonical.select(norm(F.col(ccol)).alias("__norm"), F.col(ccol).alias("__good"))
            .groupBy("__norm")
            .agg(F.min("__good").alias("__good"), F.max("__good").alias("__last"))
            .where(F.col("__good") == F.col("__last"))
        )
        out = (
            out.join(spellings, norm(out[column]) == spellings["__norm"], "left")
            .withColumn(column, F.coalesce(F.col("__good"), F.col(column)))
            .select(*cols)
        )
    return out


def value_repair(model: CrmModel, mapping: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """The fact with repaired agent names.

    A fact that holds the names itself is repaired by ``mapping`` and against
    the teams table.  Where the names are labels of a dimension, the dimension
    is repaired (one row per key) and joined once.
    """
    if "sales_agent" in model.fact().columns:
        return repair_values(model.sales(FACT_COLUMNS), "sales_agent", mapping, canonical=model.table("teams"))
    dims = tuple(
        replace(d, frame=repair_values(d.frame, "sales_agent", mapping)) if "sales_agent" in d.provides else d
        for d in model.dims
    )
    return replace(model, dims=dims).sales(FACT_COLUMNS)


def without_won_deals(model: CrmModel, name: str) -> DataFrame:
    """Keys of a dimension that no won deal refers to (the orphan check of the
    dimension against the fact)."""
    d = model.dim(name)
    parents = model.fact_keys(d.key, (WON,))
    return orphans(d.frame.select(d.key).distinct(), parents, d.key).select(F.col(d.key).cast("string").alias("key_value"))


def accounts_without_won_deals(model: CrmModel) -> DataFrame:
    return without_won_deals(model, "accounts")


def products_without_won_deals(model: CrmModel) -> DataFrame:
    return without_won_deals(model, "products")


def repeated_keys(df: DataFrame, key: str, relationship: str) -> DataFrame:
    """``(relationship, key_value, n_rows)``: values of ``key`` on several rows."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        .select(F.lit(relationship).alias("relationship"), F.col(key).cast("string").alias("key_value"), "n_rows")
    )


def repeated_opportunities(model: CrmModel) -> DataFrame:
    """Deal identifiers that are not unique."""
    return repeated_keys(model.fact().select("opportunity_id"), "opportunity_id", "sales.opportunity_id unique")


def fk_violations(model: CrmModel, dims: Sequence[str] = ("teams", "products", "accounts")) -> DataFrame:
    """``(relationship, key_value, n_rows)``: non-NULL fact keys with no parent row.

    NULL keys are exempt, as in a declared foreign key.  One scan of the deals:
    GROUPING SETS count the rows per value of each key; each count row is
    labelled with its relationship and anti-joined, in one join, with the
    keys of all parent tables labelled the same way.  The parent side must
    also be unique; see :func:`duplicate_keys`.
    """
    ds = [model.dim(name) for name in dims]
    labels = [f"sales.{d.key} -> {d.name}.{d.key}" for d in ds]
    counts, _ = model.by_key([d.key for d in ds], ("deals",))
    relationship = F.lit(None).cast("string")
    for d, label in zip(ds, labels, strict=True):
        relationship = F.when(F.col("key_name") == d.key, F.lit(label)).otherwise(relationship)
    children = counts.select(relationship.alias("relationship"), "key_value", F.col("deals").alias("n_rows")).where("key_value is not null")
    parents = None
    for d, label in zip(ds, labels, strict=True):
        part = d.frame.select(F.lit(label).alias("relationship"), F.col(d.key).cast("string").alias("key_value"))
        parents = part if parents is None else parents.unionByName(part)
    return children.join(parents, ["relationship", "key_value"], "left_anti")


def duplicate_keys(model: CrmModel, dims: Sequence[str] = ("teams", "products", "accounts")) -> DataFrame:
    """``(relationship, key_value, n_rows)``: dimension keys that are not unique."""
    parts = []
    for name in dims:
        d = model.dim(name)
        dup = repeated_keys(d.frame, d.key, f"{name}.{d.key} unique")
        parts.append(dup)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _deal_nulls(model: CrmModel, columns: Sequence[str]) -> DataFrame:
    """One row: ``n_rows`` and the NULL count ``null_<column>`` of deal-frame
    columns.  The deals are counted by key in one scan, and a key's deals
    count for each label that its dimension row lacks (all, without a row), so
    no dimension is joined to the deals.  Keys must be unique."""
    own = [c for c in columns if c in model.fact().columns]
    labels = [c for c in columns if c not in own]
    if not labels:
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in own]
        return model.fact().agg(F.count(F.lit(1)).alias("n_rows"), *nulls)
    counts, sources = model.by_key(labels, ("deals",), nulls=own)
    lacking, everything = None, F.array().cast("array<string>")
    for key, (d, names) in sources.items():
        everything = F.when(F.col("key_name") == key, F.array(*[F.lit(c) for c in names])).otherwise(everything)
        part = d.frame.select(
            F.lit(key).alias("key_name"),
            F.col(d.key).cast("string").alias("key_value"),
            F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in names])).alias("lacking"),
        )
        lacking = part if lacking is None else lacking.unionByName(part)
    joined = counts.join(lacking, ["key_name", "key_value"], "left").withColumn("lacking", F.coalesce("lacking", everything))
    once = F.col("key_name") == next(iter(sources))
    total = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    return joined.agg(
        total(once, "deals").alias("n_rows"),
        *[total(once, f"null_{c}").alias(f"null_{c}") for c in own],
        *[total(F.array_contains("lacking", c), "deals").alias(f"null_{c}") for c in labels],
    )


def null_counts(model: CrmModel, columns: Sequence[str] = FULL_SALES_COLUMNS) -> DataFrame:
    """One row: NULL count of each deal-frame column."""
    return _deal_nulls(model, columns).select(*[f"null_{c}" for c in columns])


def profile(df: DataFrame, table_name: str, counts: DataFrame | None = None) -> DataFrame:
    """``(table_name, column_name, data_type, n_rows, n_nulls)`` for one table,
    in one aggregate pass; the types come from the schema (no job).  ``counts``
    may give the row (``n_rows``, ``null_<column>``) otherwise computed."""
    if counts is None:
        counts = df.agg(
            F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
        )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"null_{f.name}").alias("n_nulls"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(F.lit(table_name).alias("table_name"), "n_rows", F.inline(rows)).select(
        "table_name", "column_name", "data_type", "n_rows", "n_nulls"
    )


def column_catalog(model: CrmModel, data_type: str | None = None) -> DataFrame:
    """Column listing of the four tables with row and NULL counts.

    ``data_type`` keeps only columns of that type (e.g. ``'string'``); the
    filter is on schema metadata, so the other columns are never aggregated.
    """
    tables = {
        "sales": model.sales(FACT_COLUMNS),
        "teams": model.table("teams"),
        "products": model.table("products"),
        "accounts": model.table("accounts"),
    }
    parts = []
    for name, df in tables.items():
        if data_type is not None:
            keep = [f.name for f in df.schema.fields if f.dataType.simpleString() == data_type]
            if not keep:
                continue
            df = df.select(*keep)
        parts.append(profile(df, name, _deal_nulls(model, df.columns) if name == "sales" else None))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _distinct_rows(found: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """Sums of ``n`` per column of ``(column_name, n)``, 0 where there is none."""
    total = found.agg(*[F.coalesce(F.sum(F.when(F.col("column_name") == c, F.col("n"))), F.lit(0)).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns])
    return total.select(F.lit(table_name).alias("table_name"), F.inline(rows))


def distinct_counts(model: CrmModel) -> DataFrame:
    """``(table_name, column_name, n_distinct)``: exact numbers of distinct
    non-NULL values in the four tables.

    The deals are grouped by every column in one scan.  The fact's own integers
    and dates are grouped as bitmaps of 64 neighbouring values, so that a
    column of dense identifiers shuffles one row for 64 deals and not one for
    each; the bits are then counted.  The distinct keys lead to the labels of
    their dimensions, of which equal ones count once.
    """
    one = F.lit(1).alias("n")
    values, sources = model.distinct_by_key(FACT_COLUMNS)
    own = [k for k, (_, names) in sources.items() if names == [k]]
    labels = None
    for key, (d, names) in sources.items():
        if key in own:
            continue
        entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("label")) for c in names])
        part = d.frame.select(
            F.lit(key).alias("key_name"),
            F.col(d.key).cast("string").alias("key_value"),
            F.filter(entries, lambda e: e["label"].isNotNull()).alias("entries"),
        )
        labels = part if labels is None else labels.unionByName(part)
    found = values.where(F.col("key_value").isNotNull())
    if labels is None:
        found = found.select(F.col("key_name").alias("column_name"), F.col("n_values").alias("n"))
    else:
        itself = F.array(F.struct(F.col("key_name").alias("column_name"), F.lit(None).cast("string").alias("label")))
        found = (
            found.join(labels, ["key_name", "key_value"], "left")
            .select("n_values", F.inline(F.when(F.col("key_name").isin(own), itself).otherwise(F.col("entries"))))
            .groupBy("column_name", "label")
            .agg(F.sum("n_values").alias("n"))
            .select("column_name", F.when(F.col("label").isNull(), F.col("n")).otherwise(F.lit(1)).alias("n"))
        )
    out = _distinct_rows(found, FACT_COLUMNS, "sales")
    for d in model.dims:
        columns = list(d.table_columns)
        listed = by_single_key(d.frame.select(*columns), columns).where(F.col("key_value").isNotNull())
        out = out.unionByName(_distinct_rows(listed.select(F.col("key_name").alias("column_name"), one), columns, d.name))
    return out
