"""The corpus pipeline against brute force on rows with repeated and null ids."""

from __future__ import annotations

import os
import random
import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from salescope.llm import store
from tests.llm.test_near_dedup import check_one_of_each_group, edited, groups_of


def corpus():
    draw = random.Random(9)
    rows = []
    for _ in range(20):
        words = [f"w{draw.randrange(3000)}" for _ in range(90)]
        rows += [" ".join(edited(draw, words, n % 2)) for n in range(4)]
    draw.shuffle(rows)
    return [(None if i % 3 == 0 else i % 11, t) for i, t in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", f"s{n % 4}") for n, r in enumerate(rows)], "doc_id long, text string, lang string, source string")


def test_near_dedup_stage_keeps_a_text_of_every_group(spark):
    rows = [*corpus(), (None, None), (None, ""), (3, " ")]
    docs = frame(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    check_one_of_each_group(rows, [(r.doc_id, r.text) for r in kept.collect()], 5, 80)


def test_run_packs_every_group_once(spark, tmp_path):
    """Without labels only the base counts reject, here the short texts."""
    rows = [*corpus(), (None, "too short"), (5, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the sort")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    long = [r for r in rows if r[1] and len(r[1].split()) >= 50]
    assert len(packed) == len(set(groups_of(long, 5, 80)))


def test_columns_named_like_the_stages_own_stay(spark):
    """Own columns called like a stage's, in every stage that filters."""
    rows = [(i, " ".join(f"w{(i * 31 + j) % 700}" for j in range(80)), 0.987, 5, "own", 7, None, True) for i in range(12)]
    names = "doc_id long, text string, score double, n_words long, kept string, predicted int, rest string, hit boolean"
    docs = spark.createDataFrame(rows, names)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.dtypes == docs.dtypes
        assert {tuple(r) for r in got.collect()} <= set(rows)
        assert got.count() > 0
        assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0


def test_intermediate_tables_go(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the sort")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    store.clear(spark)
    found = corpus_pipeline.run(spark, str(tmp_path))
    before = found.count()
    left = os.listdir(store._folder(spark).removeprefix("file:"))
    assert [x.split("-")[0] for x in left] == ["pipeline"]
    assert found.count() == before
    kept = os.listdir(f"{store._folder(spark).removeprefix('file:')}/{left[0]}")
    assert [x.split("-")[0] for x in kept] == ["decontamination"]


def test_quality_stage_learns_from_every_trusted_document(spark, tmp_path):
    """24,000 trusted documents: 72 with mostly words of their own (they set the
    threshold), and ten pairs whose words only the partner, of the other fold,
    knows.  A pair with a partner that a sample leaves out would be rejected."""
    own = F.expr("if(id < 72 and i < 31, concat('j', id, '_', i), concat('w', pmod(xxhash64(id, i), 200)))")
    words = spark.range(24_000).select("id", F.explode(F.sequence(F.lit(0), F.lit(51))).alias("i")).withColumn("word", own)
    most = words.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w")).select(F.col("id").alias("doc_id"), F.array_join("w.word", " ").alias("text"))
    pairs = []
    for n in range(10):
        text = " ".join(f"p{n}_{i}" for i in range(52))
        other = next(o for m in range(99) if (zlib.crc32((o := f"{text} x{m}").encode()) ^ zlib.crc32(text.encode())) & 1)
        pairs += [(30_000 + 2 * n, text), (30_001 + 2 * n, other)]
    most.union(spark.createDataFrame(pairs, most.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_low_quality(spark, docs, str(tmp_path)).collect()}
    assert kept >= {i for i, _ in pairs}
