import numpy as np
from pyspark.sql import functions as F

from salescope.llm.quality_classifier import STATISTICS, discriminant, fit, quality_classifier, statistics, with_statistics
from salescope.llm.toxicity import held_out

SF = "/root/testdata/sf0.1"


def of(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return dict(zip(STATISTICS, statistics(data, np.array([0, len(data)]))[0], strict=True))


def test_statistics_by_hand():
    got = of("One two two. ÉÉ!!\n3 3 3\n3 3 3")
    words, usual = 10, 30
    assert np.isclose(got["words"], np.log(11))
    assert np.isclose(got["word_length"], np.log((3 + 3 + 4 + 4 + 6 + 5 * usual) / (words + usual)))
    assert np.isclose(got["upper"], np.sqrt((1 + 0.05 * 150) / (9 + 150)))
    assert np.isclose(got["digits"], np.sqrt(6 / 40))
    assert np.isclose(got["loud"], np.sqrt(2 / 40))
    assert np.isclose(got["dup_lines"], np.sqrt(1 / 6))
    assert np.isclose(got["repeats"], np.sqrt(6 / 40))
    assert np.isclose(got["distinct"], np.log(35 / 40))
    assert np.isclose(got["commonest"], np.sqrt((6 + 0.05 * 30) / 40))
    assert np.isclose(got["rough_ends"], np.sqrt(1 / 20))
    assert np.isclose(got["doubled"], np.sqrt(5 / 20))


def test_differences_equal_the_two_densities():
    rng = np.random.default_rng(3)
    x = {0: rng.normal(size=(300, 4)) * [1, 2, 3, 0.5] + 1, 1: rng.normal(size=(500, 4))}
    sums = {k: (len(v), v.sum(axis=0), v.T @ v) for k, v in x.items()}
    model = discriminant(sums, 0.0, 0.0)

    def log_density(v, k):
        c = np.cov(x[k].T, bias=True)
        d = v - x[k].mean(axis=0)
        return -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) + np.linalg.slogdet(c)[1])

    points = rng.normal(size=(50, 4)) * 3
    assert np.allclose(model.differences(points), log_density(points, 1) - log_density(points, 0))


def test_fit_sums_all_labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    points = with_statistics(docs.select("doc_id", "text"))
    model = fit(points, labels, 0.2, 0.02)
    x = {r["doc_id"]: r["x"] for r in points.collect()}
    label = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] in x}
    rows = {k: np.array([x[i] for i, q in label.items() if q == k]) for k in (0, 1)}
    plain = discriminant({k: (len(v), v.sum(axis=0), v.T @ v) for k, v in rows.items()}, 0.2, 0.02)
    every = np.array(list(x.values()))
    assert np.allclose(model.differences(every), plain.differences(every))


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality_classifier(docs, labels).where(held_out(F.col("doc_id"))).join(labels, "doc_id")
    got = {(r["quality"], r["predicted"]): r["n"] for r in judged.groupBy("quality", "predicted").agg(F.count("*").alias("n")).collect()}
    assert got.get((0, 1), 0) <= 4 and got.get((1, 0), 0) <= 2 and got[0, 0] > 100


def test_labels_held_out_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality_classifier(docs, x).collect()} for x in (labels, turned))
    assert a == b or max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (2, None, 3), (3, "a b. " * 100_000, 4), (3, "a b. " * 100_000, 4), (4, "\n \t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (1, 0), (1, 1), (None, 0), (2, None), (4, 0)], "doc_id long, quality int")
    got = quality_classifier(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] != 3}) == 1
    unlabelled = quality_classifier(docs.withColumn("x", F.lit(1)), labels.where("false")).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality_classifier(docs.where("false"), labels).count() == 0
