"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.store import materialise


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Count and checksum of an edge set."""
    part = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))
    got = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(part), F.lit(0)).alias("s")).first()
    return got["n"], got["s"]


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of the undirected ``edges`` (a, b: long);
    ``root`` is the smallest vertex of its component.

    Large star: a vertex's larger neighbours are moved to its smallest one;
    small star: the rest follow.  Each step sends a vertex's edges to its
    minimum (one row per vertex, aggregated before the shuffle), so a hub is
    spread by the skewed-join handling.  Every round is written to the shared
    folder, which cuts lineage; the rounds end when the edge set stays as it
    is (logarithmically many in practice).  No edges give an empty result.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = materialise(pairs, "edges")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = materialise(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, mark = mark, _mark(pairs)
        if before == mark:
            break
    roots = pairs.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots.unionAll(pairs.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
