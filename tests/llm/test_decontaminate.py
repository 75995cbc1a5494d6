from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from salescope.llm.decontaminate import contamination, decontaminate
from salescope.llm.queries import op6_decontamination

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for item, test in items:
            ts = words(test)
            size = min(width, len(ts))
            grams = {tuple(ts[i : i + size]) for i in range(len(ts) - size + 1)} if size else set()
            for i in range(len(ws) - size + 1):
                if tuple(ws[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def corpus():
    draw = random.Random(9)
    items = [(i, " ".join(f"t{draw.randrange(500)}" for _ in range(draw.choice([0, 1, 4, 10, 25, 40])))) for i in range(12)]
    items += [(3, "Hello, World"), (40, None), (41, "!!!"), (42, items[5][1])]
    docs = []
    for i in range(60):
        ws = [f"d{draw.randrange(5000)}" for _ in range(draw.randrange(80))]
        for _ in range(draw.randrange(3)):
            ts = words(draw.choice(items)[1])
            a = draw.randrange(len(ts) + 1)
            ws[draw.randrange(len(ws) + 1) : 0] = [w.upper() + draw.choice(["", ",", "é-"]) for w in ts[a : a + draw.choice([9, 10, 14, 40])]]
        docs.append((i, draw.choice([" ", "\n", " - "]).join(ws)))
    return docs + [(60, None), (61, ""), (62, "hello world"), (62, "hello world"), (63, "x " * 50_000 + "hello_world")], items


def test_against_brute_force(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = op6_decontamination(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items)


def test_several_blocks_give_the_same(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, items string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    one, many = contamination(df, tests), contamination(df, tests, block=20)
    key = ["doc_id", "text", "n_words", "hit_spans", "items"]
    assert one.select(key).exceptAll(many.select(key)).count() == 0
    assert one.where(F.size("hit_spans") > 0).count() > 5


def test_removal_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "keep this. Alpha  beta, gamma! and this", 5), (2, "clean", 6), (3, None, 7)], "doc_id long, text string, n_words int")
    tests = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate(df, tests).orderBy("doc_id").collect()] == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate(df, tests, remove="spans").collect()}
    assert cut == {1: "keep this. ! and this", 2: "clean", 3: None}
    assert decontaminate(df.limit(0), tests).count() == 0
    assert decontaminate(df, tests.limit(0)).count() == 3
    assert decontaminate(df, tests).columns == df.columns
    for how in ("documents", "spans"):  # a column named like a found one stays
        assert {r.n_words for r in decontaminate(df, tests, remove=how).collect()} <= {5, 6, 7}
