"""Quality rules: base counts and an n-gram likelihood ratio.

Two multinomials over words and word pairs (64-bit hashes, none sharing a
bucket) are counted: the raw corpus (every document) and the trusted target
(every document labelled good and never bad).  A document's score is the mean
over its features of ``log p_target - log p_raw``, so it doesn't grow with
length.  A feature that the target lacks has the same ratio
whatever its raw count, so raw counts are kept for the target's features alone,
which loses nothing; the number of distinct features of the whole corpus, for
the smoothing, is estimated by a HyperLogLog sketch.  The counts are held in
two folds by the text's checksum and a document is scored with the other fold,
so that neither its own words nor those of its exact copies speak for it.

The threshold is fixed by the corpus alone: the ``keep_quantile`` of the
trusted documents' own (cross-fitted) scores, less ``margin``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from salescope.llm.store import materialise, read_bytes, shared_folder, write_bytes
from salescope.llm.textops import SPACED, Words, chunks, mix, span_hash, table
from salescope.operators.selection import rows_at

SYMBOLS = table("#*$%&|<>")
_ROW = np.uint64(0xA24BAED4963EE407)
#: Features that a task holds before it sums their counts; it sends them off
#: when more than half as many are left.
_BUFFER = 1 << 21
#: Index bits of the sketch of distinct features.
_HLL = 14
#: Groups in which the tasks' sketches are merged, the rest on the driver.
_FAN = 64
#: Bytes of text for each slice of the features, and the least slices.
_SLICE, _LEAST = 1 << 26, 16
#: Ids of the target that are broadcast; more are joined by a shuffle.
_BROADCAST = 1 << 20

METRICS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "score": "double",
    "kept": "boolean",
}


class Features:
    """Sorted 64-bit features in files, each the range after the one before.
    A worker maps the files when it first needs them."""

    def __init__(self, names: list[str], sizes: list[int]):
        self.names, self.sizes = names, sizes

    def _open(self) -> tuple[list[np.ndarray], np.ndarray]:
        if "_held" not in self.__dict__:
            held = [read_bytes(name)[: 8 * size].view(np.uint64) for name, size in zip(self.names, self.sizes, strict=True)]
            self._held = held, np.array([h[0] for h in held], dtype=np.uint64)
        return self._held

    def found(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of sorted ``hashes``: file, places among them, places in the file."""
        held, least = self._open()
        ends = np.append(np.searchsorted(hashes, least), len(hashes))
        for i, features in enumerate(held):
            part = hashes[ends[i] : ends[i + 1]]
            if len(part):
                spot = np.minimum(np.searchsorted(features, part), len(features) - 1)
                same = np.flatnonzero(features[spot] == part)
                if len(same):
                    yield i, same + ends[i], spot[same]


@dataclass(frozen=True)
class QualityModel:
    """``ratios``: files of the log likelihood ratios of ``features``, for texts
    of either fold; ``other``: those of all other features; texts scoring under
    ``threshold`` are rejected."""

    features: Features
    ratios: list[str]
    other: np.ndarray
    threshold: float

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        """Ratios of sorted ``hashes``, a row for each fold."""
        if "_held" not in self.__dict__:
            self.__dict__["_held"] = [_unpacked_ratios(read_bytes(name)) for name in self.ratios]
        out = np.repeat(self.other[:, None], len(hashes), axis=1)
        for i, at, spot in self.features.found(hashes):
            pairs, codes = self._held[i]
            out[:, at] = pairs[codes[spot]].T
        return out


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word and word pair."""
    pairs, inside = words.windows(2)
    return np.concatenate([words.hash, pairs[inside]]), np.concatenate([words.rows, words.rows[: len(inside)][inside]])


_Counts = tuple[np.ndarray, np.ndarray]


def _counted(hashes: np.ndarray, fold: np.ndarray) -> _Counts:
    """Sorted distinct hashes, and their counts in both folds."""
    order = np.argsort(hashes)
    hashes, fold = hashes[order], fold[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(hashes)))
    ones = np.add.reduceat(fold, first) if len(first) else n
    return hashes[first], np.stack([n - ones, ones])


def _summed(parts: list[_Counts]) -> _Counts:
    """One table of several."""
    hashes = np.concatenate([h for h, _ in parts])
    counts = np.concatenate([c for _, c in parts], axis=1)
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return hashes[first], np.add.reduceat(counts[:, order], first, axis=1)


def _packed(counts: np.ndarray) -> bytes:
    """A slice of the counts of both folds, in the least bytes that hold them."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[1:]), dtype=f"u{packed[0]}").reshape(2, -1).astype(np.int64)


def _sent(held: list[_Counts], fresh: _Counts) -> tuple[list[_Counts], list[_Counts]]:
    """What a task holds after ``fresh``, and what it sends off."""
    held = [*held, fresh] if len(fresh[0]) else held
    if sum(len(h) for h, _ in held) > _BUFFER:
        held = [_summed(held)]
        if len(held[0][0]) > _BUFFER // 2:
            return [], held
    return held, []


def _packed_ratios(ratio: np.ndarray) -> list[bytes]:
    """Number of the distinct pairs of both folds' ratios (rare features share
    their counts, so they are few), the pairs, and each feature's pair."""
    pairs, codes = np.unique(np.ascontiguousarray(ratio.T).view(np.uint64)[:, 0], return_inverse=True)
    return [np.int64(len(pairs)).tobytes(), pairs.tobytes(), codes.astype(np.min_scalar_type(len(pairs) - 1)).tobytes()]


def _unpacked_ratios(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = int(packed[:8].view(np.int64)[0])
    return packed[8 : 8 + 8 * n].view(np.float32).reshape(-1, 2), packed[8 + 8 * n :].view(np.min_scalar_type(n - 1))


def _packed_keys(keys: np.ndarray, base: int) -> bytes:
    """Sorted keys from ``base`` on: their differences, in the least bytes that hold them."""
    steps = np.diff(keys, prepend=np.uint64(base))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + zlib.compress(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 1)


def _unpacked_keys(packed: bytes, base: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed[1:]), dtype=np.uint8).reshape(packed[0], -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, : packed[0]] = planes.T
    return np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(base)


def _cut(counts: _Counts, bases: list[int]) -> Iterator[pa.RecordBatch]:
    """A batch for each range of keys that holds some; ranges start at ``bases``."""
    keys, n = counts
    ends = [*np.searchsorted(keys, np.array(bases, dtype=np.uint64)), len(keys)]
    for i, base in enumerate(bases):
        a, b = ends[i], ends[i + 1]
        if b > a:
            columns = [pa.array([i], pa.int32()), pa.array([_packed_keys(keys[a:b], base)], pa.binary()), pa.array([_packed(n[:, a:b])], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "hashes", "counts"])


def _sketched(registers: np.ndarray, hashes: np.ndarray) -> None:
    """Add hashes to the registers of a HyperLogLog sketch."""
    rest = (hashes << np.uint64(_HLL)) >> np.uint64(12)  # 52 bits: exact as a float
    rank = np.minimum(53 - np.frexp(rest.astype(float))[1], 53).astype(np.uint8)
    np.maximum.at(registers, (hashes >> np.uint64(64 - _HLL)).astype(np.int64), rank)


def _distinct(registers: np.ndarray) -> float:
    """Number of distinct hashes in a sketch."""
    m, empty = len(registers), int((registers == 0).sum())
    guess = 0.7213 / (1 + 1.079 / m) * m * m / (2.0 ** -registers.astype(float)).sum()
    return m * np.log(m / empty) if empty and guess < 2.5 * m else guess


def _folds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    whole = data.tobytes()
    return np.array([zlib.crc32(whole[a:b]) & 1 for a, b in zip(offsets[:-1], offsets[1:], strict=True)], dtype=np.int64)


def base_metrics(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """The base counts of each row of a chunk."""
    n = len(offsets) - 1
    out = {
        "n_words": np.diff(words.first),
        "word_chars": _per_row(words.mark & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(SYMBOLS[data], offsets),
    }
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    row = np.searchsorted(offsets, starts, side="right") - 1
    # a row's text ends where the next begins; empty rows share a start
    ends = np.sort(np.concatenate([offsets[1:], breaks]))
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(words.mark, out=marks[1:])
    full = marks[ends] > marks[starts]
    starts, ends, row = starts[full], ends[full], row[full]
    key = mix(span_hash(data, starts, ends) + row.astype(np.uint64) * _ROW)
    first = np.unique(key, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)
    three, inside = words.windows(3)
    at = np.flatnonzero(inside)
    key = mix(three[at] + words.rows[at].astype(np.uint64) * _ROW)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words.rows), dtype=bool)
    for j in range(3):
        covered[at[again] + j] = True
    out["n_repeat_words"] = np.bincount(words.rows[covered], minlength=n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def _trusted(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good and never bad."""
    return (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select(F.col("doc_id").alias("_trusted_id"))
    )


def _target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents labelled good: ids and texts, every row of an id.  Up to
    ``_BROADCAST`` ids go to the texts; beyond that the texts are shuffled,
    once, and written for both of their readers."""
    ids = materialise(_trusted(labels), "trusted")
    few = ids.count() <= _BROADCAST
    rows = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_trusted_id"), "left_semi")
    return rows if few else materialise(rows, "target")


def _slices(docs: DataFrame) -> int:
    """How many slices the features are cut into: a power of two that grows
    with the texts, so that a slice and the parts it is summed from don't."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(_LEAST, 1 << max(0, math.ceil(size / _SLICE) - 1).bit_length())


def _target_slices(trusted: DataFrame, folder: str, slices: int) -> list[Row]:
    """Count the features of ``trusted`` and write them to ``folder``, one file
    for each range of hashes: the sorted hashes, then both folds' counts.  The
    files' names, sizes and sums are returned, one row for each."""
    bases = [i << 64 - (slices - 1).bit_length() for i in range(slices)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Counts] = []
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(1)):
                hashes, rows = _features(Words(data, offsets, SPACED))
                held, sent = _sent(held, _counted(hashes, _folds(data, offsets)[rows]))
                for part in sent:
                    yield from _cut(part, bases)
        if held:
            yield from _cut(_summed(held), bases)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        base = bases[group["slice"].iloc[0]]
        hashes, counts = _summed([(_unpacked_keys(h, base), _unpacked(c)) for h, c in zip(group["hashes"], group["counts"], strict=True)])
        name = write_bytes(f"{folder}/target", [hashes.data, _packed(counts)])
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "target": [name], "size": [len(hashes)], "n0": [counts[0].sum()], "n1": [counts[1].sum()]})

    parts = trusted.mapInArrow(count, "slice int, hashes binary, counts binary")
    return sorted(parts.groupBy("slice").applyInPandas(merge, "slice int, target string, size long, n0 long, n1 long").collect())


def _raw_slices(docs: DataFrame, features: Features, folder: str) -> tuple[dict[int, str], np.ndarray, float]:
    """Count the features over all of ``docs``: the files of the counts by
    slice, the folds' totals of all features, and the number of distinct ones.
    A task sends the counts of the features that its texts hold, by their
    numbers among ``features``; sketches and totals go as slices below 0."""
    starts = [0, *np.cumsum(features.sizes).tolist()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Counts] = []
        registers, total = np.zeros(1 << _HLL, dtype=np.uint8), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                hashes, rows = _features(Words(data, offsets, SPACED))
                found, n = _counted(hashes, _folds(data, offsets)[rows])
                _sketched(registers, found)
                total += n.sum(axis=1)
                known = [(spot.astype(np.uint64) + np.uint64(starts[i]), n[:, at]) for i, at, spot in features.found(found)]
                if known:
                    held, sent = _sent(held, (np.concatenate([k for k, _ in known]), np.concatenate([c for _, c in known], axis=1)))
                    for part in sent:
                        yield from _cut(part, starts[:-1])
        if held:
            yield from _cut(_summed(held), starts[:-1])
        if total.any():
            place = -1 - TaskContext.get().partitionId() % _FAN
            columns = [pa.array([place], pa.int32()), pa.array([registers.tobytes()], pa.binary()), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "hashes", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        i = group["slice"].iloc[0]
        if i < 0:
            registers, total = _merged_sketches(group["hashes"], group["counts"])
            return pd.DataFrame({"slice": [i], "raw": [None], "registers": [registers.tobytes()], "total": [total.tobytes()]})
        counts = np.zeros((2, features.sizes[i]), dtype=np.int64)
        for h, c in zip(group["hashes"], group["counts"], strict=True):
            counts[:, _unpacked_keys(h, 0)] += _unpacked(c)
        return pd.DataFrame({"slice": [i], "raw": [write_bytes(f"{folder}/raw", [_packed(counts)])], "registers": [None], "total": [None]})

    parts = docs.select("text").mapInArrow(count, "slice int, hashes binary, counts binary")
    got = parts.groupBy("slice").applyInPandas(merge, "slice int, raw string, registers binary, total binary").collect()  # a row for each slice
    told = [r for r in got if r["slice"] < 0]
    registers, total = _merged_sketches([r["registers"] for r in told], [r["total"] for r in told])
    return {r["slice"]: r["raw"] for r in got if r["slice"] >= 0}, total, _distinct(registers)


def _merged_sketches(registers: Iterable[bytes], totals: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    most = np.max([np.frombuffer(r, dtype=np.uint8) for r in registers], axis=0)
    return most, np.sum([np.frombuffer(t, dtype=np.int64) for t in totals], axis=0)


def _quantile(scores: DataFrame, q: float) -> float | None:
    """``percentile_disc`` of the column ``score`` by exact selection: no task
    holds the distinct scores."""
    scores = materialise(scores.select(F.struct("score").alias("__key")), "scores")
    n = scores.count()
    place = max(1, math.ceil(n * q))
    return rows_at(scores, [place])[place][0] if n else None


def fit(
    docs: DataFrame,
    labels: DataFrame,
    prior: float = 0.5,
    keep_quantile: float = 0.001,
    margin: float = 0.03,
    least_words: int = 50,
    slices: int | None = None,
) -> QualityModel:
    """Count the two multinomials and fix the threshold.

    The raw corpus counts cover every document, the target's and the threshold
    every document labelled good; ``prior`` is the weight of the raw
    distribution in the target's smoothing.  Each task sums its documents'
    counts before anything is shuffled.  The features, their counts and their
    ratios lie in the shared folder, cut by hash into ``slices`` files (a power
    of two, from the size of the texts unless given) that tasks write and map;
    the driver gets their names and totals.  Without trusted documents the ratio
    is zero and nothing is rejected for it.
    """
    trusted = _target(docs, labels)
    folder = shared_folder(docs.sparkSession, "quality")
    target = _target_slices(trusted, folder, slices or _slices(docs))
    if not target:
        return QualityModel(Features([], []), [], np.zeros(2, np.float32), -np.inf)
    features = Features([r["target"] for r in target], [r["size"] for r in target])
    raw, total, distinct = _raw_slices(docs, features, folder)
    distinct = max(distinct, float(sum(features.sizes)))
    goals = [sum(r["n0"] for r in target), sum(r["n1"] for r in target)]

    def ratios(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = []
            for name, size, counts in zip(batch["target"], batch["size"], batch["raw"], strict=True):
                goal = _unpacked(bytes(read_bytes(name)[8 * size :])).astype(float)
                seen = _unpacked(bytes(read_bytes(counts))).astype(float)
                ratio = np.zeros((2, size), dtype=np.float32)
                for k in (0, 1):  # a text is scored by the other fold
                    if goals[1 - k]:
                        p_raw = (seen[1 - k] + 1) / (total[1 - k] + distinct)
                        ratio[k] = np.log((goal[1 - k] / goals[1 - k] + prior * p_raw) / (1 + prior)) - np.log(p_raw)
                names.append(write_bytes(f"{folder}/ratio", _packed_ratios(ratio)))
            yield pd.DataFrame({"slice": batch["slice"], "ratio": names})

    rows = [(i, r["target"], r["size"], raw[i]) for i, r in enumerate(target)]
    table = docs.sparkSession.createDataFrame(rows, "slice int, target string, size long, raw string").repartition(len(rows), "slice")
    named = {r["slice"]: r["ratio"] for r in table.mapInPandas(ratios, "slice int, ratio string").collect()}
    other = np.array([np.log(prior / (1 + prior)) if goals[1 - k] else 0.0 for k in (0, 1)], dtype=np.float32)
    model = QualityModel(features, [named[i] for i in range(len(rows))], other, -np.inf)
    low = _quantile(judge(trusted, model).where(F.col("n_words") >= least_words), keep_quantile)
    return model if low is None else replace(model, threshold=low - margin)


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with the base counts, the score and the verdict of every row.

    A null text has no words.  ``base_failed``: under 50 words, or more than
    half of them in repeated three-word windows; such rows are not kept.  The
    new columns replace columns of their names; an empty table stays empty.
    """
    rest = [c for c in docs.columns if c not in METRICS]
    kept = docs.select(*rest)
    schema = kept.withColumns({c: F.lit(None).cast(t) for c, t in METRICS.items()}).schema
    place = rest.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {c: [] for c in METRICS}
            for _, _, data, offsets in chunks(batch.column(place)):
                words = Words(data, offsets, SPACED)
                base = base_metrics(data, offsets, words)
                n = len(offsets) - 1
                hashes, rows = _features(words)
                order = np.argsort(hashes)
                hashes, rows = hashes[order], rows[order]
                new = np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.zeros(0, bool)
                weight = model.weights(hashes[new])[_folds(data, offsets)[rows], np.cumsum(new) - 1]
                score = np.bincount(rows, weights=weight, minlength=n) / np.maximum(1, np.bincount(rows, minlength=n))
                failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
                base |= {"base_failed": failed, "score": score, "kept": ~failed & (score >= model.threshold)}
                for c, v in base.items():
                    found[c].append(v)
            if batch.num_rows:
                made = [pa.array(np.concatenate(found[c])) for c in METRICS]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*rest, *METRICS])

    return kept.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Fit on ``docs`` and ``labels`` (see :func:`fit`) and judge every row."""
    return judge(docs, fit(docs, labels, **parameters))
