from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import salescope.llm.quality_rules as module
from salescope.llm.quality_rules import fit, judge, quality_rules


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(three)
    covered = {j for i, w in enumerate(three) if count[w] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


TEXTS = [
    None, "", " \n\t ", "one", "é ü ß 日本 😀", "a b c a b c", "x\nx\n\nx \n x", "# * $ % & | < >", "a b\x0bc\x0cd\re",
    "same line\n" * 30, "w " * 40_000, " ".join(map(str, range(60))), "\n".join(f"line {i % 7} here" for i in range(50)),
]


def test_base_counts_against_plain_python(spark):
    draw = random.Random(3)
    texts = TEXTS + ["".join(draw.choices(["a", "b", "cé", " ", " ", "\n", "#"], k=draw.randrange(400))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_rules(df, labels).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text), text
        assert r.kept == (not r.base_failed)  # nothing is trusted: nothing else rejects


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(11)
    clean = [f"w{i}" for i in range(400)]
    junk = [f"j{i}$" for i in range(400)]
    docs = [(i, " ".join(draw.choices(clean if i % 5 else junk, k=200))) for i in range(300)]
    return docs, [(i, int(i % 5 > 0), 0) for i in range(0, 300, 2)]


def test_junk_is_rejected_and_clean_text_kept(spark, corpus):
    docs, labels = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_rules(df, lab).where("kept").collect()}
    assert kept == {i for i, _ in docs if i % 5}


def test_model_does_not_depend_on_the_partitions(spark, corpus):
    docs, labels = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one, many = fit(df.coalesce(1), lab), fit(df.repartition(13), lab.repartition(5))
    assert one.threshold == many.threshold
    scores = [sorted((r.doc_id, r.score) for r in judge(df, model).collect()) for model in (one, many)]
    assert scores[0] == scores[1]


def test_any_number_of_files_gives_the_same_scores(spark, corpus):
    docs, labels = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scores = [sorted((r.doc_id, r.score) for r in quality_rules(df, lab, slices=n).collect()) for n in (1, 2, 64)]
    assert scores[0] == scores[1] == scores[2]


def test_edges(spark):
    df = spark.createDataFrame(
        [(1, "a b", "x", 1.0), (1, "a b", "x", 1.0), (None, None, None, None)], "doc_id long, text string, lang string, score double"
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    model = fit(df, labels)
    assert judge(df, model).count() == 3
    assert judge(df.limit(0), model).count() == 0
    assert quality_rules(df.limit(0), labels).count() == 0
    assert quality_rules(df, labels.limit(0)).columns.count("score") == 1


def test_scores_against_exact_counts(spark):
    """Many times more features than 65,536: none shares its counts."""
    draw = random.Random(2)
    docs = [(i, " ".join(f"w{draw.randrange(draw.choice([200, 200_000]))}" for _ in range(300))) for i in range(500)]
    good = {i for i, _ in docs if i % 2}

    def features(text):
        words = text.split()
        return [*words, *zip(words, words[1:])]

    raw, target = [Counter(), Counter()], [Counter(), Counter()]
    for i, text in docs:
        raw[zlib.crc32(text.encode()) & 1].update(features(text))
        if i in good:
            target[zlib.crc32(text.encode()) & 1].update(features(text))
    distinct = len({*raw[0], *raw[1]})
    assert distinct > 2 * 65_536

    def score(text):
        k = 1 - (zlib.crc32(text.encode()) & 1)
        n, t, total = raw[k].total() + distinct, target[k].total(), 0.0
        for f in (found := features(text)):
            p = (raw[k][f] + 1) / n
            total += math.log((target[k][f] / t + 0.5 * p) / 1.5) - math.log(p)
        return total / len(found)

    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_rules(df, labels).collect()}
    assert max(abs(got[i] - score(text)) for i, text in docs) < 0.02


def test_every_trusted_document_counts(spark):
    """More than the 20,000 that a sample of the labels once held; half of the
    ids are labelled twice."""
    draw = random.Random(7)
    docs = [(i, " ".join(f"w{draw.randrange(3_000)}" for _ in range(8))) for i in range(22_000)]
    good = {i for i, _ in docs if i % 20}

    def features(text):
        words = text.split()
        return [*words, *zip(words, words[1:])]

    raw, target = [Counter(), Counter()], [Counter(), Counter()]
    for i, text in docs:
        raw[zlib.crc32(text.encode()) & 1].update(features(text))
        if i in good:
            target[zlib.crc32(text.encode()) & 1].update(features(text))
    distinct = len({*raw[0], *raw[1]})

    def score(text):
        k = 1 - (zlib.crc32(text.encode()) & 1)
        n, t, total = raw[k].total() + distinct, target[k].total(), 0.0
        for f in (found := features(text)):
            p = (raw[k][f] + 1) / n
            total += math.log((target[k][f] / t + 0.5 * p) / 1.5) - math.log(p)
        return total / len(found)

    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in good] + [(i, int(i in good)) for i, _ in docs[::2]], "doc_id long, quality int")
    model = fit(df, labels, least_words=8)
    got = {r.doc_id: r.score for r in judge(df, model).collect()}
    assert max(abs(got[i] - score(text)) for i, text in docs) < 0.02
    own = sorted(got[i] for i in good)
    assert model.threshold == own[math.ceil(len(own) * 0.001) - 1] - 0.03


def test_large_tables_give_the_same_scores(spark, corpus, monkeypatch):
    """Ids beyond the broadcast, and more slices."""
    docs, labels = corpus
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = fit(df, lab)
    monkeypatch.setattr(module, "_BROADCAST", 0)
    monkeypatch.setattr(module, "_SLICE", 1 << 10)
    got = fit(df, lab)
    assert len(got.features.names) > len(want.features.names) and got.threshold == want.threshold
    scores = [sorted((r.doc_id, r.score) for r in judge(df, model).collect()) for model in (want, got)]
    assert scores[0] == scores[1]


def test_keys_and_ratios_come_back_as_packed():
    for base, keys in ((0, [0]), (0, [0, 1, 255, 256, 2**64 - 1]), (7 << 61, [7 << 61, (7 << 61) + 5, 2**64 - 1]), (10, [11, 12, 13])):
        assert module._unpacked_keys(module._packed_keys(np.array(keys, dtype=np.uint64), base), base).tolist() == keys
    for n, values in ((5, 1), (1_000, 300), (80_000, 80_000)):
        ratio = (np.arange(2 * n) % values).astype(np.float32).reshape(2, n)
        pairs, codes = module._unpacked_ratios(np.frombuffer(b"".join(module._packed_ratios(ratio)), dtype=np.uint8))
        assert (pairs[codes].T == ratio).all()


def test_counts_sent_at_a_bound_are_whole(monkeypatch):
    monkeypatch.setattr(module, "_BUFFER", 50)
    draw = np.random.default_rng(5)
    held, parts, want = [], [], Counter()
    for top in (20, 1_000) * 10 + (20,):
        hashes = draw.integers(0, top, 40).astype(np.uint64)
        want.update(hashes.tolist())
        held, sent = module._sent(held, module._counted(hashes, np.zeros(40, dtype=np.int64)))
        parts += sent
    assert len(parts) > 1 and held
    keys, counts = module._summed([*parts, *held])
    assert dict(zip(keys.tolist(), counts[0].tolist(), strict=True)) == want and not counts[1].any()
