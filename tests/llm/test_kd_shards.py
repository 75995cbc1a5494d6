from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from salescope.llm.copies import counted, expanded
from salescope.llm.kd_shards import kd_shards


def rows_of(n, seed=1):
    draw = random.Random(seed)
    alphabet = ["a", "é", "日", " ", "\n"]
    return [(i, "".join(draw.choices(alphabet, k=int(draw.expovariate(1 / 80))))) for i in range(n)]


def check(rows, out, shards):
    assert len(out) == len(rows)
    data = defaultdict(list)
    for i, t in rows:
        b = (t or "").encode()
        data[i].append((len(b) + 1, zlib.crc32(b)))
    assert all((r["size"], r.text_crc32) in data[r.doc_id] for r in out)
    slots, of_text, load = defaultdict(list), defaultdict(set), [0] * shards
    for r in out:
        slots[r.shard].append(r.slot)
        of_text[(r["size"], r.text_crc32)].add(r.shard)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    return load


def test_bytes_are_near_equal(spark):
    rows = rows_of(4000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = kd_shards(df, shards=16, bucket_rows=50).collect()
    load = check(rows, out, 16)
    assert max(load) - min(load) < 0.05 * sum(load) / 16 + 2 * max(r["size"] for r in out)
    again = kd_shards(df.coalesce(2), shards=16, bucket_rows=50).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_target_bytes_and_odd_counts(spark):
    rows = rows_of(1500, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    total = sum(len(t.encode()) + 1 for _, t in rows)
    load = check(rows, kd_shards(df, target_bytes=-(-total // 5)).collect(), 5)
    assert max(load) < 1.2 * total / 5
    with pytest.raises(ValueError):
        kd_shards(df)


def test_a_hot_text_takes_a_leaf_and_the_rest_is_balanced(spark):
    rows = rows_of(1200, 5) + [(10_000 + i, "the very same text") for i in range(2500)]
    load = check(rows, kd_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect(), 8)
    rest = sorted(load)[:-1]
    assert max(rest) < 2 * sum(rest) / len(rest)


def test_a_third_of_equal_rows(spark):
    rows = rows_of(600, 5) + [(7, "the same row")] * 200 + [(None, None)] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = kd_shards(df, shards=4, bucket_rows=40).collect()
    check(rows, out, 4)
    assert Counter(r.doc_id for r in out)[7] >= 200


def test_copies_there_and_back(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (1, None)] + [(2, "b")] * 20_000, "i long, t string")
    back = expanded(counted(df, "n"), "n", "copy")
    assert Counter((r.i, r.t) for r in back.collect()) == Counter((r.i, r.t) for r in df.collect())
    assert sorted(r.copy for r in back.where("i = 2").collect()) == list(range(20_000))


def test_edges(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "x" * 300_000), (3, "a"), (3, "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, size int")
    check(rows, kd_shards(df, shards=4).collect(), 4)
    assert kd_shards(df.limit(0), shards=4).count() == 0
    assert {r.shard for r in kd_shards(df, shards=1).collect()} == {0}
