import hashlib
import math
import random

from salescope.llm.centroid_clusters import centroid_clusters

SCHEMA = "vec_id long, embedding array<float>, cluster string, row string"


def brute(rows, k, rounds, dims):
    """Plain Python: [(vec_id, cluster, distance, cluster inertia, inertia, hash)]."""
    import numpy as np

    points = []
    for vec_id, v, *_ in rows:
        if v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        points.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    order = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), q) for i, q in points)
    centroids = [q for _, q in order[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        held = [[] for _ in centroids]
        for _, q in points:
            held[nearest(q)[1]].append(q)
        centroids = [[sum(x) // len(qs) for x in zip(*qs)] if qs else c for c, qs in zip(centroids, held)]
    found = [(i, *nearest(q)) for i, q in points]
    total = sum(d for _, d, _ in found)
    out = []
    for i, d, c in found:
        name = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out.append((i, c, d, sum(e for _, e, x in found if x == c), total, name))
    return sorted(out, key=repr)


def run(spark, rows, **parameters):
    got = centroid_clusters(spark.createDataFrame(rows, SCHEMA), **parameters)
    cols = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr)


def test_equals_plain_python_with_ties_and_a_hot_vector(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.125, 0.5]) for _ in range(4)], "x", "y") for i in range(120)]
    rows += [(1000 + i, [0.25] * 4, "x", "y") for i in range(60)]
    rows += [rows[3], rows[3]]
    rows += [(5000, None, "x", "y"), (5001, [0.1] * 3, None, None), (5002, [0.1, None, 0.1, 0.1], "x", "y")]
    rows += [(5003, [float("nan")] * 4, "x", "y"), (5004, [float("inf"), 0.0, 0.0, 0.0], "x", "y"), (5005, [], "x", "y")]
    rows += [(None, [0.75, 0.75, -0.75, 0.75], "x", "y"), (None, [0.5, 0.75, -0.75, 0.75], "x", "y")]
    for k, rounds in ((7, 5), (40, 3), (1, 1)):
        assert run(spark, rows, k=k, rounds=rounds, dims=4) == brute(rows, k, rounds, 4)


def test_few_rows_and_empty_tables(spark):
    rows = [(1, [0.5, -0.3], "a", "b")]
    assert run(spark, rows, k=40, dims=2) == brute(rows, 40, 5, 2)
    assert run(spark, [], k=40, dims=2) == []
    assert run(spark, [(1, None, "a", "b")], k=40, dims=2) == []


def test_extra_columns_stay_and_clashing_ones_are_replaced(spark):
    got = centroid_clusters(spark.createDataFrame([(1, [0.5, -0.3], "a", "b")], SCHEMA), dims=2).first().asDict()
    assert got["row"] == "b" and got["cluster"] == 0 and "embedding" not in got
