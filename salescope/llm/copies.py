"""Equal rows as one row with their number, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies that one row stands for when copies are spread out again.
BLOCK = 8192


def counted(df: DataFrame, n: str) -> DataFrame:
    """The distinct rows of ``df`` with their number ``n``: a row that fills a
    third of the table costs one row a task."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))


def expanded(df: DataFrame, n: str, copy: str) -> DataFrame:
    """Each row of ``df`` as many times as its ``n`` says, numbered from 0 in
    ``copy``.  Rows of many copies are dealt out in blocks before they grow."""
    rest = [c for c in df.columns if c != n]
    few = df.where(F.col(n) <= BLOCK).select(*rest, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias(copy))
    many = df.where(F.col(n) > BLOCK).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / BLOCK))))
    many = many.repartition(*rest, "block")
    first = F.col("block") * BLOCK
    many = many.select(*rest, F.explode(F.sequence(first, F.least(first + BLOCK, F.col(n)) - 1)).alias(copy))
    return few.unionByName(many)
