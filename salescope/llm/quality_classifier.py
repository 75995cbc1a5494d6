"""Quality classifier: a regularised quadratic discriminant.

Every document becomes a vector of transformed statistics of its text.  Each
class has a mean and a covariance, shrunk towards the covariance within all
classes and then towards a multiple of the identity.  The difference of the two log
densities, half the difference of the squared Mahalanobis distances and log
determinants, is found from the classes' Cholesky factors, which are computed
once.  A logistic curve fitted to the labelled differences turns it into a
score.

All labelled rows are learned from: their counts, sums and products are summed
in Spark, and so is a histogram of the differences; the driver gets tables of a
size fixed by the number of statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.quality_rules import SYMBOLS, base_metrics
from salescope.llm.store import materialise
from salescope.llm.textops import SPACED, Words, chunks, mix, table
from salescope.llm.toxicity import held_out

_UPPER = table("", ((0x41, 0x5A),))
_LOWER = table("", ((0x61, 0x7A),))
_DIGIT = table("", ((0x30, 0x39),))
_LOUD = table("!?")
_PAUSE = table(".,;:")
_STOP = table(".!?")
_LINE = table("\n")
_LETTER = table("", ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))
_ROW = np.uint64(0xA24BAED4963EE407)
#: Words that every text is given of the usual kind, so that short texts don't
#: stray for chance alone.
_USUAL = 30.0
#: The same for marks that usual texts hardly have.
_RARE = 10.0

STATISTICS = (
    "words", "word_length", "symbols", "upper", "digits", "loud", "pauses", "sentence", "lines", "dup_lines", "repeats", "distinct", "commonest", "rough_ends",
    "doubled",
)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text: logarithms of sizes, roots
    of shares."""
    words = Words(data, offsets, SPACED)
    base = base_metrics(data, offsets, words)
    n, n_words = len(offsets) - 1, base["n_words"].astype(float)

    def count(kind: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(kind[data], out=total[1:])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def share(part: np.ndarray, usual: float, of: np.ndarray = n_words, weight: float = _USUAL) -> np.ndarray:
        return np.sqrt((part + usual * weight) / (of + weight))

    key = mix(words.hash + words.rows.astype(np.uint64) * _ROW)
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    distinct = np.bincount(words.rows[first], minlength=n).astype(float)
    commonest = np.zeros(n)
    np.maximum.at(commonest, words.rows[first], times)
    upper, lower = count(_UPPER), count(_LOWER)
    lines = count(_LINE)
    ends = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    rough = np.bincount(words.rows[~(_LETTER | _DIGIT | _PAUSE)[ends]], minlength=n).astype(float)
    same = (words.hash[1:] == words.hash[:-1]) & (words.rows[1:] == words.rows[:-1])
    doubled = np.bincount(words.rows[1:][same], minlength=n).astype(float)
    return np.column_stack(
        [
            np.log1p(n_words),
            np.log((base["word_chars"] + 5 * _USUAL) / (n_words + _USUAL)),
            share(base["n_symbols"], 0.0, weight=_RARE),
            share(upper, 0.05, upper + lower, 5 * _USUAL),
            share(count(_DIGIT), 0.0),
            share(count(_LOUD), 0.0),
            share(count(_PAUSE), 0.15),
            np.log((n_words + _USUAL) / (count(_STOP) + _USUAL / 10)),
            share(lines, 0.02),
            share(base["n_dup_lines"], 0.0, lines + 1, 3.0),
            share(base["n_repeat_words"], 0.0),
            np.log((distinct + _USUAL) / (n_words + _USUAL)),
            share(commonest, 0.05),
            share(rough, 0.0, weight=_RARE),
            share(doubled, 0.0, weight=_RARE),
        ]
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with ``x``: the statistics of every whole
    text.  A null text counts as empty."""
    rest = [c for c in docs.columns if c not in ("text", "x")]
    schema = docs.select(*rest).withColumn("x", F.lit(None).cast("array<double>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [statistics(data, offsets) for _, _, data, offsets in chunks(batch.column(len(rest)))]
            if parts:
                x = np.concatenate(parts)
                flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], flat], names=schema.names)

    return docs.select(*rest, "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """Of class 0 and 1: mean, inverse of the Cholesky factor of the
    covariance, and log determinant; ``centre`` and ``spread`` scale the
    statistics.  ``slope`` and ``offset`` turn the difference into a score."""

    centre: np.ndarray = field(repr=False)
    spread: np.ndarray = field(repr=False)
    means: tuple[np.ndarray, np.ndarray] = field(repr=False)
    factors: tuple[np.ndarray, np.ndarray] = field(repr=False)
    log_dets: tuple[float, float]
    slope: float = 1.0
    offset: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        z = (x - self.centre) / self.spread
        log = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - d / 2 for m, f, d in zip(self.means, self.factors, self.log_dets, strict=True)]
        return log[1] - log[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(x) + self.offset, -500, 500)))


def discriminant(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float, ridge: float) -> Discriminant:
    """From ``(n, sum, sum of outer products)`` of both classes."""
    n = sum(s[0] for s in sums.values())
    centre = sum(s[1] for s in sums.values()) / n
    spread = np.sqrt(np.maximum(np.diag(sum(s[2] for s in sums.values())) / n - centre**2, 1e-12))
    spread[spread < 1e-5] = 1.0
    size = len(centre)
    means, own = [], []
    for k in (0, 1):
        m, total, outer = sums[k]
        mean = total / m
        own.append((outer / m - np.outer(mean, mean)) / np.outer(spread, spread))
        means.append((mean - centre) / spread)
    pooled = sum(sums[k][0] * own[k] for k in (0, 1)) / n
    factors, dets = [], []
    for c in own:
        c = (1 - shrink) * c + shrink * pooled
        c = (1 - ridge) * c + ridge * max(np.trace(c) / size, 1e-6) * np.eye(size)
        low = np.linalg.cholesky((c + c.T) / 2)
        factors.append(np.linalg.inv(low))
        dets.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(centre, spread, (means[0], means[1]), (factors[0], factors[1]), (dets[0], dets[1]))


def _curve(values: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through a histogram (Newton,
    with the classes' smoothed targets)."""
    good, bad = counts[labels == 1].sum(), counts[labels == 0].sum()
    goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = 10.0
    x = np.column_stack([values / scale, np.ones(len(values))])
    w = np.array([1.0, np.log((good + 1) / (bad + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - goal)) + 1e-3 * w
        step = np.linalg.solve((x.T * (counts * p * (1 - p))) @ x + 1e-3 * np.eye(2), grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-6) / scale, float(w[1])


def fit(points: DataFrame, labels: DataFrame, shrink: float = 0.2, ridge: float = 0.02) -> Discriminant | None:
    """Fit on the rows of ``points`` (doc_id, x) that ``labels`` (doc_id,
    quality) marks, all of them; ids with both labels are left out.  Without
    rows of both classes there is no model."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("high"))
    known = known.where("label = high").select(F.col("doc_id").alias("of"), F.col("label").cast("int").alias("label"))
    taught = materialise(points.join(known, F.col("doc_id") == F.col("of")).select("label", "x"), "taught")
    size = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            label = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(-1, size)
            for k in np.unique(label).tolist():
                z = x[label == k]
                total = np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
                held[k] = held.get(k, 0) + total
        for k, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(v), pa.int32()), pa.array(range(len(v)), pa.int32()), pa.array(v)], names=["label", "at", "v"])

    got = taught.mapInArrow(moments, "label int, at int, v double").groupBy("label", "at").agg(F.sum("v").alias("v"))
    sums: dict[int, np.ndarray] = {}
    for r in got.collect():  # a fixed number of rows
        sums.setdefault(r["label"], np.zeros(1 + size + size * size))[r["at"]] = r["v"]
    if len(sums) < 2:
        return None
    parted = {k: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for k, v in sums.items()}
    model = discriminant(parted, shrink, ridge)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = model.differences(batch.column(1).flatten().to_numpy().reshape(-1, size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(np.round(d * 4), -400, 400).astype(np.int32))], names=["label", "bin"])

    drawn = taught.mapInArrow(bins, "label int, bin int").groupBy("label", "bin").agg(F.count(F.lit(1)).alias("n")).collect()  # 1,602 rows at most
    label, at, n = (np.array([r[c] for r in drawn], dtype=float) for c in ("label", "bin", "n"))
    slope, offset = _curve(at / 4, label, n)
    return Discriminant(model.centre, model.spread, model.means, model.factors, model.log_dets, slope, offset)


def score(points: DataFrame, model: Discriminant | None, cut: float = 0.3) -> DataFrame:
    """``points`` with ``score`` and ``predicted`` (1 from ``cut`` on) in place
    of ``x``.  Without a model every score is 0.5."""
    rest = [c for c in points.columns if c not in ("x", "score", "predicted")]
    schema = points.select(*rest).withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    size = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(rest)).flatten().to_numpy().reshape(-1, size)
            s = np.full(len(x), 0.5) if model is None else model.scores(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(s), pa.array((s >= cut).astype(np.int32))], names=schema.names)

    return points.select(*rest, "x").mapInArrow(run, schema)


def quality_classifier(docs: DataFrame, labels: DataFrame, cut: float = 0.3, **parameters) -> DataFrame:
    """``docs`` (doc_id, text and any others) without the text, with ``score``
    (0 to 1) and ``predicted`` of every row, learned from the ``labels`` that
    are not held out.

    Only the text makes a score.  The statistics are computed once and written;
    texts are never shuffled, and a document's row is slim from there on.  A
    null text counts as empty; an empty text has the statistics of no words.
    Rows that repeat are rows of their own, and taught as such; a null doc_id is
    scored and has no label.  Columns named x, score or predicted are replaced;
    an empty table gives an empty result, and a table without labels of both
    kinds scores of 0.5.
    """
    points = materialise(with_statistics(docs), "statistics")
    model = fit(points.select("doc_id", "x"), labels.where(~held_out(F.col("doc_id"))), **parameters)
    return score(points, model, cut)
