from __future__ import annotations

import random
import re

import pytest

from salescope.llm.graph import components
from salescope.llm.near_dedup import deduplicate, near_duplicates


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= k:
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    low = {c: min((r[0] for r, x in zip(rows, comp, strict=True) if x == c and r[0] is not None), default=None) for c in set(comp)}
    return sorted(((r[0], len(s), low[c], r[0] == low[c]) for r, s, c in zip(rows, sets, comp, strict=True)), key=repr)


def edited(draw, words, n):
    out = list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"e{draw.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    texts = []
    for _ in range(25):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([3, 20, 80, 200]))]
        texts += [" ".join(edited(draw, words, n % 5)) for n in range(6)]
    hot = [f"h{i}" for i in range(120)]
    texts += [" ".join(edited(draw, hot, draw.randrange(1, 4))) for _ in range(60)] + [" ".join(hot).upper()] * 40
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{draw.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    texts += [None, "", " \n", "one", "ONE", "one two", "one\ttwo", "ß É", "ß é", "long " * 30_000]
    draw.shuffle(texts)
    return list(enumerate(texts))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("leaf", [4096, 8])
def test_equals_brute_force(spark, corpus, leaf):
    """With leaves of 8 the large groups go through levels, blocks, pivots and guests."""
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    got = near_duplicates(df, shingle=3, percent=85, leaf=leaf, levels=2)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows_of(got) == brute(corpus, 3, 85)


def test_repeated_ids_nulls_and_empty_tables(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y z u v w"), (None, "a b c d e f"), (None, "k l m n o p"), (7, "x y z u v w"), (8, None)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, kept string")
    got = rows_of(near_duplicates(df, shingle=3, percent=85))
    want = [(1, 4, 1, True)] * 3 + [(None, 4, 1, False), (None, 4, None, True), (7, 4, 1, False), (8, 0, 8, True)]
    assert got == sorted(want, key=repr)
    assert near_duplicates(df.limit(0)).count() == 0
    kept = deduplicate(df, shingle=3, percent=85)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, "a b c d e f"), (1, "x y z u v w"), (8, None), (None, "k l m n o p")], key=repr
    )


def groups_of(rows, k, percent):
    """Component number of every row, by brute force; None without shingles."""
    sets = [shingles(t, k) for _, t in rows]
    comp = [i if s else None for i, s in enumerate(sets)]
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    return comp


def check_one_of_each_group(rows, kept, k, percent):
    """One text of every group, of its smallest id, and all texts without words."""
    comp = groups_of(rows, k, percent)
    rank = lambda i: (i is None, i or 0)
    low = {}
    for (i, _), c in zip(rows, comp, strict=True):
        if c is not None:
            low[c] = min(low.get(c, i), i, key=rank)
    of = {(i, t): c for (i, t), c in zip(rows, comp, strict=True)}
    worded = [r for r in kept if of[r] is not None]
    assert sorted(of[r] for r in worded) == sorted(low)
    assert all(r[0] == low[of[r]] for r in worded)
    bare = [r for r, c in zip(rows, comp, strict=True) if c is None]
    assert sorted((r for r in kept if of[r] is None), key=repr) == sorted(bare, key=repr)


def test_deduplicate_keeps_a_text_of_every_group(spark, corpus):
    """Ids repeat and a third of them is missing; texts are compared."""
    few = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y z u v w"), (None, "a b c d e f"), (None, "k l m n o p"), (7, "x y z u v w"), (8, None), (8, None)]
    many = [(None if i % 3 == 0 else i % 40, t) for i, t in corpus]
    for rows in (few, many):
        df = spark.createDataFrame([(*r, n % 4) for n, r in enumerate(rows)], "doc_id long, text string, source int")
        got = [deduplicate(df.repartition(n), shingle=3, percent=85).collect() for n in (1, 5)]
        assert sorted(got[0], key=repr) == sorted(got[1], key=repr)
        check_one_of_each_group(rows, [(r.doc_id, r.text) for r in got[0]], 3, 85)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1002, 1001), (5, 5)] + [(2000, i) for i in range(2001, 2100)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    want = {i: 0 for i in range(301)} | {i: 1000 for i in (1000, 1001, 1002)} | {i: 2000 for i in range(2000, 2100)}
    assert got == want
