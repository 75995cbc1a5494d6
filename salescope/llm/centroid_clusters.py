"""Integer k-means with literal centroids, in JVM expressions only.

Vectors are quantised to integers and written once.  In each round a vector's
squared distance to every centroid is an ``aggregate`` over a ``zip_with`` of
its components and the centroid's, the centroids being one literal array;
``array_min`` over ``(distance, number)`` picks the nearest and, among equals,
the smaller number.  The components are then summed as columns of one hash
aggregate, which combines in every task before it shuffles one row per cluster
and task, so a cluster that holds a third of all vectors costs no more than
another.  The driver sees ``k`` rows a round.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.store import materialise

_OWN = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def quantised(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """The usable rows of ``vectors`` with ``q``: each component as
    ``floor(scale * x)``.  Usable: exactly ``dims`` components, none null or
    non-finite."""
    unfit = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.when(F.size("embedding") == dims, ~unfit)
    q = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(F.coalesce(whole, F.lit(False))).withColumn("q", q)


def first_centroids(points: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``q`` of the ``k`` rows with the smallest SHA-256 of
    ``<seed>:<vec_id>``, ascending; equal hashes by the components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = points.select(F.sha2(name, 256).alias("h"), "q").orderBy("h", "q").limit(k)
    return [list(r["q"]) for r in rows.collect()]


def _nearest(centroids: list[list[int]]) -> Column:
    """``(distance, cluster)`` of the nearest centroid."""
    zero = F.lit(0).cast("long")

    def distance(c: Column) -> Column:
        return F.aggregate(F.zip_with("q", c, lambda a, b: a - b), zero, lambda s, d: s + d * d)

    # folded to one literal when the plan is optimised
    table = F.from_json(F.lit(json.dumps(centroids)), "array<array<bigint>>")
    return F.array_min(F.transform(table, lambda c, i: F.struct(distance(c).alias("distance"), i.alias("cluster"))))


def moved(points: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after one round: componentwise floor of the mean of their
    vectors; a centroid without vectors stays."""
    sums = [F.sum(F.col("q")[j]).alias(f"s{j}") for j in range(dims)]
    placed = points.select("q", _nearest(centroids)["cluster"].alias("cluster"))
    out = [list(c) for c in centroids]
    for r in placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # k rows
        out[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(dims)]
    return out


def centroid_clusters(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2"
) -> DataFrame:
    """The usable rows of ``vectors`` (vec_id, embedding and any others) without
    the embedding, with ``cluster``, ``distance`` (squared, to the final
    centroid), ``cluster_inertia``, ``inertia`` (sums of the distances over the
    cluster and over all) and ``centroid_sha256`` (of the final centroid's
    components, as decimal integers joined by commas).

    Rows that repeat are rows of their own, also as first centroids; a null id
    hashes like an empty one.  Fewer usable rows than ``k`` give as many
    clusters.  Rows that are not usable (see :func:`quantised`) are left out;
    without usable rows the result is empty.  Sums beyond 64 bits raise an
    error in Spark's ANSI mode.  The new columns replace columns of their
    names.
    """
    rest = [c for c in vectors.columns if c not in ("embedding", "q", *_OWN)]
    # the rows' other columns wait in a struct: no name of theirs is in the way
    slim = vectors.select(F.struct(*rest).alias("row"), "vec_id", "embedding")
    points = materialise(quantised(slim, dims, scale).select("row", "vec_id", "q"), "vectors")
    centroids = first_centroids(points, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(points, centroids, dims)
    best = _nearest(centroids) if centroids else F.struct(F.lit(0).cast("long").alias("distance"), F.lit(0).alias("cluster"))
    placed = materialise(points.select("row", best.alias("best")), "clusters")
    sums = placed.groupBy("best.cluster").agg(F.sum("best.distance").alias("s"))
    inertia = {r["cluster"]: r["s"] for r in sums.collect()}  # k rows
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids or [[]]]
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("best.cluster") + 1)
    return placed.select(
        "row.*",
        "best.cluster",
        "best.distance",
        of([inertia.get(i, 0) for i in range(len(names))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of(names).alias("centroid_sha256"),
    )
