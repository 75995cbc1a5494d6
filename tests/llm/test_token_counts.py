from __future__ import annotations

import random

import pytest

from salescope.llm.token_counts import default_model, merger, token_counts

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


CASES = [
    "", " ", "    ", "a\x00b", "▁▁ ▁x", "<s></s><unk><0x41>", "日本語テキスト", "a" * 2000, " " * 700, "the" * 900,
    "\n\n \t", "é" * 300, "😀😀 x", "x " * 500, "thequickbrownfoxjumpsoverthelazydog" * 60,
]


def test_counts_equal_the_library(library):
    draw = random.Random(7)
    texts = CASES + ["".join(draw.choices("thein orang▁ \n—é日 ingtion00<>", k=draw.randrange(120))) for _ in range(1500)]
    texts += ["".join(draw.choices("theinoragl", k=2500)) for _ in range(10)]
    got = merger(default_model()).count(texts)
    assert got.tolist() == [len(ids) for ids in library.encode(texts)]


def test_frame(spark, library):
    rows = [(i, t, "kept") for i, t in enumerate(CASES)] + [(None, None, None), (3, CASES[3], "kept")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts(df, limit=100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 100))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts(df.limit(0)).count() == 0


def test_unfit_models_are_refused(tmp_path):
    with pytest.raises((OSError, RuntimeError)):
        merger(str(tmp_path / "none.model"))
