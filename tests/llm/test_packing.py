from __future__ import annotations

import random
from collections import Counter, defaultdict

from salescope.llm.packing import best_fit, pack


def naive(sizes, sources, clusters, capacity, quota):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        fits = [
            (b["room"], i)
            for i, b in enumerate(bins)
            if b["room"] >= size and b["room"] and b["sources"][source] < quota and (cluster is None or cluster not in b["clusters"])
        ]
        if not fits:
            bins.append({"room": capacity, "sources": Counter(), "clusters": set()})
        i = min(fits)[1] if fits else len(bins) - 1
        bins[i]["room"] -= size
        bins[i]["sources"][source] += 1
        bins[i]["clusters"].add(cluster)
        out.append(i)
    return out


def test_best_fit_against_a_naive_search():
    for seed in range(120):
        draw = random.Random(seed)
        n = draw.randrange(200)
        sizes = sorted((draw.randrange(70) for _ in range(n)), reverse=True)
        sources = [draw.choice(["hot", "hot", None, *range(draw.choice([2, 200]))]) for _ in range(n)]
        clusters = [draw.choice([None, "hot", "hot", *range(draw.choice([3, 300]))]) for _ in range(n)]
        quota = draw.randrange(1, 4)
        assert best_fit(sizes, sources, clusters, 70, quota) == naive(sizes, sources, clusters, 70, quota)


def test_runs_of_like_pieces_against_a_naive_search():
    for seed in range(60):
        draw = random.Random(seed)
        pieces = []
        for _ in range(draw.randrange(12)):
            like = (draw.randrange(0, 40), draw.choice(["a", "b", None]), draw.choice([None, 1, 2, 3]))
            pieces += [like] * draw.randrange(1, 12)
        pieces.sort(key=lambda p: -p[0])
        columns = [list(c) for c in zip(*pieces)] or [[], [], []]
        quota = draw.randrange(1, 4)
        assert best_fit(*columns, 70, quota) == naive(*columns, 70, quota)


def test_rows_that_repeat_are_spread_over_the_groups(spark):
    rows = [(1, "the same text", "s")] * 20_000 + [(None, None, None)] * 5_000 + [(i, f"text {i}", "s") for i in range(5_000)]
    out = pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), group_rows=2000).collect()
    assert len(out) == len(rows)
    groups = Counter(r.bin.split("-")[0] for r in out)
    assert len(groups) == 15 and max(groups.values()) < 3000
    copies = Counter(r.bin for r in out if r.doc_id == 1 and r["size"] == 13)
    assert max(copies.values()) == 1


def test_every_byte_is_packed_within_the_constraints(spark):
    draw = random.Random(2)
    rows = [(i, "é" * draw.randrange(120), draw.choice(["hot", "hot", "a", "b", None])) for i in range(400)]
    rows += [(400 + i, "a copy of a text", "hot") for i in range(200)] + [(900, "y" * 5000, "a"), (901, None, "a"), (902, "", None), (903, "z" * 256, "b"), (903, "z" * 256, "b"), (None, "n", "b")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, bin string").repartition(6)
    out = pack(df, capacity=256, quota=2, group_rows=100).collect()
    text = {(i, s): t for i, t, s in rows}
    pieces, bins = Counter(), defaultdict(list)
    for r in out:
        pieces[r.doc_id] += r.size
        bins[r.bin].append(r)
    sizes = Counter()
    for i, t, _ in rows:
        sizes[i] += len((t or "").encode())
    assert pieces == sizes and set(pieces) == set(sizes)
    for held in bins.values():
        assert sum(r.size for r in held) <= 256
        assert max(Counter(r.source for r in held).values()) <= 2
        texts = [text[r.doc_id, r.source] for r in held if text[r.doc_id, r.source]]
        assert len(texts) == len(set(texts))
        assert sorted(r.position for r in held) == list(range(len(held)))
    assert {(r.offset, r.size) for r in out if r.doc_id == 900} == {(i * 256, min(256, 5000 - i * 256)) for i in range(20)}
    again = pack(df.coalesce(1), capacity=256, quota=2, group_rows=100).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert pack(df.limit(0)).count() == 0
