from __future__ import annotations

import inspect
import random
import zlib

import numpy as np
import pytest

from salescope.llm.toxicity import DECAY, LENGTH, SPAN, _norm, fit, kernel, labelled_sample, score, toxicity, train

INSULTS = ["blockhead", "nitwit", "numbskull", "dimwit"]


def vocabulary(draw, n):
    parts = ["ba", "ke", "lo", "mi", "tu", "ra", "sen", "dor", "vi", "pel"]
    return ["".join(draw.choices(parts, k=draw.randrange(2, 5))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    common = vocabulary(draw, 800)
    docs, labels = [], []
    for i in range(900):
        words = draw.choices(common, k=draw.randrange(10, 90))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words) + 1), draw.choice(INSULTS))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(corpus):
    docs, labels = corpus
    return train([t for (_, t), (_, y) in zip(docs, labels, strict=True) if y], [t for (_, t), (_, y) in zip(docs, labels, strict=True) if not y])


def naive(a, b):
    from itertools import combinations

    def features(s):
        s = "\x01" + s + "\x01"
        out = {}
        for i in combinations(range(len(s)), LENGTH):
            if i[-1] - i[0] < SPAN:
                u = tuple(s[j] for j in i)
                out[u] = out.get(u, 0) + DECAY ** (i[-1] - i[0] + 1)
        return out

    fa, fb = features(a), features(b)
    return sum(w * fb.get(u, 0) for u, w in fa.items()) / float(_norm(np.array([len(a)]))[0] * _norm(np.array([len(b)]))[0])


def test_kernel_against_enumeration():
    words = ["nitwit", "nxitwit", "ab", "a", "blockhead", "lockheads", "zzzzzz"]
    got = kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(got[i, j] - naive(a, b)) < 1e-4


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    truth = dict(labels)
    held = [(r.doc_id, r.predicted) for r in toxicity(df, lab).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100
    assert sum(truth[i] == p for i, p in held) / len(held) > 0.98


def test_gaps_and_inserted_characters(model):
    clean = model.scores(["balo mitu rasen dorvi pelba"])[0]
    for s in ("you block-head", "a nit.wit here", "n i t w i t", "numb*skull", "dimxwit"):
        assert model.scores([s])[0] > clean + 0.05, s
    assert (model.scores(INSULTS) > 0.5).all()


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "nitwit " + "ba " * 60_000), (5, "x" * 100_000 + "nitwit"), (4, "nitwit"), (None, "balo")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, score string")
    got = score(df, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    rows = got.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.predicted == 0 for r in rows if r.doc_id in (1, 2, 3)) and all(r.predicted == 1 for r in rows if r.doc_id == 4)
    assert score(df.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(df, none).where("predicted = 1").count() == 0


def test_default_sample_takes_1500_toxic_and_6000_harmless(spark):
    bounds = [inspect.signature(fit).parameters[n].default for n in ("n_toxic", "n_harmless")]
    docs = spark.range(8000).selectExpr("id doc_id", "'a' text")
    labels = docs.selectExpr("doc_id", "int(doc_id < 1600) toxic")
    assert {r.toxic: r["count"] for r in labelled_sample(docs, labels, *bounds).groupBy("toxic").count().collect()} == {1: 1500, 0: 6000}
