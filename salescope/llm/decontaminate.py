"""Benchmark decontamination by a broadcast hash set of test n-grams.

The windows of normalised words of every benchmark item are hashed.  Each
training text is scanned window by window against the hash set; every hit is
verified word by word.  The hit words give the spans, and spans or whole
documents can be removed.

The hash set is broadcast in blocks of at most ``block`` windows.  A benchmark
beyond one block is matched in several passes over the texts, each adding its
hits, so its size is no limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.store import materialise
from salescope.llm.textops import ALNUM, LOWER, Words, chunks, windows

_FOUND = {"n_words": "long", "hit_spans": "array<struct<from:int,to:int>>", "items": "array<string>"}


def _window_hash(hashes: np.ndarray) -> int:
    """Hash of a whole sequence as one window."""
    return int(windows(hashes, np.zeros(len(hashes), np.int64), len(hashes))[0][0])


def benchmark_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``(length, hash, words, item)``: the distinct windows of every item,
    words separated by one space.  An item of fewer words than a window, but
    not none, is one window; a null item_id counts as ``null``."""
    source = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows = []
            for at, _, data, offsets in chunks(batch.column(1)):
                found = Words(data, offsets, ALNUM, LOWER)
                whole = found.folded.tobytes()
                for r, (a, b) in enumerate(zip(found.first[:-1], found.first[1:], strict=True)):
                    text = [whole[s:e] for s, e in zip(found.starts[a:b], found.ends[a:b], strict=True)]
                    size = min(width, b - a)
                    for i in range(a, b - size + 1) if size else ():
                        value = np.uint64(_window_hash(found.hash[i : i + size])).astype(np.int64)
                        rows.append((size, int(value), b" ".join(text[i - a : i - a + size]), names[at + r]))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.string())],
                names=["length", "hash", "words", "item"],
            )

    return source.mapInArrow(run, "length int, hash long, words binary, item string").distinct()


class WindowSet:
    """One block of windows, with a bit filter before the exact table."""

    def __init__(self, rows: list[tuple[int, int, bytes, str]]):
        self.table: dict[tuple[int, int], dict[bytes, list[str]]] = {}
        for length, value, words, item in rows:
            self.table.setdefault((length, value & 0xFFFFFFFFFFFFFFFF), {}).setdefault(words, []).append(item)
        self.shift = np.uint64(64 - max(16, min(24, (32 * len(rows)).bit_length())))
        self.filters: dict[int, np.ndarray] = {}
        for length, value in self.table:
            bits = self.filters.setdefault(length, np.zeros(1 << (64 - int(self.shift)), dtype=bool))
            bits[value >> int(self.shift)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """``(first word, length, items)`` of every verified hit."""
        whole: bytes | None = None
        for length, bits in self.filters.items():
            values, inside = words.windows(length)
            for i in np.flatnonzero(bits[(values >> self.shift).astype(np.int64)] & inside):
                known = self.table.get((length, int(values[i])))
                if known:
                    whole = words.folded.tobytes() if whole is None else whole
                    spans = zip(words.starts[i : i + length], words.ends[i : i + length], strict=True)
                    items = known.get(b" ".join(whole[a:b] for a, b in spans))
                    if items:
                        yield int(i), length, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(docs: DataFrame, rows: list[tuple[int, int, bytes, str]]) -> DataFrame:
    """``docs`` with the hits of one block added to those found before."""
    rest = [c for c in docs.columns if c not in _FOUND]
    before = [c for c in ("hit_spans", "items") if c in docs.columns]
    schema = docs.select(*rest).withColumns({c: F.lit(None).cast(t) for c, t in _FOUND.items()}).schema
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    place = rest.index("text")
    span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = WindowSet(shared.value)
        for batch in batches:
            n = batch.num_rows
            n_words = np.zeros(n, dtype=np.int64)
            spans: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            if before:
                for r, (old, names) in enumerate(zip(batch.column("hit_spans").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                    if old:
                        spans[r] = [(s["from"], s["to"]) for s in old]
                        items[r] = set(names)
            for at, to, data, offsets in chunks(batch.column(place)):
                words = Words(data, offsets, ALNUM, LOWER)
                n_words[at:to] = np.diff(words.first)
                for i, length, names in block.hits(words):
                    r = int(words.rows[i])
                    start = i - int(words.first[r])
                    spans.setdefault(at + r, []).append((start, start + length))
                    items.setdefault(at + r, set()).update(names)
            merged = [[{"from": a, "to": b} for a, b in _merge(spans[r])] if r in spans else [] for r in range(n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], pa.array(n_words), pa.array(merged, span), pa.array([sorted(items.get(r, ())) for r in range(n)], pa.list_(pa.string()))],
                names=[*rest, *_FOUND],
            )

    return docs.select(*rest, *before).mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block: int = 250_000) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word positions, merged) and
    ``items`` (sorted ids of the items with occurring windows) of every row.

    Words are runs of letters, digits and characters beyond ASCII, A-Z
    lower-cased.  A null text has no words.  A narrow map for each block of the
    benchmark.  The new columns replace columns of their names; an empty table
    or benchmark gives rows without hits.
    """
    tests = materialise(benchmark_windows(benchmark, width), "windows")
    blocks = max(1, -(-tests.count() // block))
    found = docs.drop("hit_spans", "items")
    for i in range(blocks):
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("hash", "words", "item"), F.lit(blocks)) == i)
        if i:
            found = materialise(found, "hits")
        found = _scan(found, [tuple(r) for r in part.collect()])
    return found


def _cut(docs: DataFrame) -> DataFrame:
    """``docs`` whose texts lack the words of ``hit_spans``."""
    rest = [c for c in docs.columns if c not in _FOUND]
    place = rest.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for r, spans in enumerate(batch.column("hit_spans").to_pylist()):
                if spans:
                    for _, _, data, offsets in chunks(batch.column(place).slice(r, 1)):
                        words = Words(data, offsets, ALNUM, LOWER)
                        whole = data.tobytes()
                        at, left = 0, []
                        for s in spans:
                            left.append(whole[at : words.starts[s["from"]]])
                            at = int(words.ends[s["to"] - 1])
                        texts[r] = b"".join([*left, whole[at:]]).decode()
            columns = list(batch.columns[: len(rest)])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=rest)

    return docs.select(*rest, "hit_spans").mapInArrow(run, docs.select(*rest).schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **parameters) -> DataFrame:
    """``docs`` without the contaminated documents (``remove="documents"``) or
    with their hit spans cut from the text (``"spans"``).  Columns of ``docs``
    that are named like the found ones stay as they are."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in _FOUND}
    found = contamination(docs.withColumnsRenamed(aside), benchmark, **parameters)
    back = [F.col(aside.get(c, c)).alias(c) for c in docs.columns]
    if remove == "documents":
        return found.where(F.size("hit_spans") == 0).select(*back)
    if remove == "spans":
        return _cut(found).select(*back)
    raise ValueError("remove must be 'documents' or 'spans'")
