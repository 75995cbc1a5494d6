"""Toxicity by a subsequence string kernel machine with Nyström landmarks.

The kernel of two short strings is the gappy subsequence kernel: the sum, over
all sequences of four characters, of the products of their weights in either
string, where each occurrence weighs ``decay ** span`` and spans are bounded.
Gaps and inserted characters therefore cost a factor, not the match.

Training takes labelled sentences: those of documents labelled harmless, and
those of documents labelled toxic, of which only some words can be to blame.
The words of the toxic sentences that recur in unlike surroundings and don't
occur in harmless sentences are the positive strings; harmless strings that
the machine scores highest are added round by round.  The strings are mapped
by Nyström's method, ``K(x, L) K(L, L)^(-1/2)``, to landmarks ``L``, and a
linear support vector machine is fitted on them.

The fitted machine is linear in the kernel, so the landmarks collapse into one
weight per four-character sequence, and a text is scored in one pass over its
characters.  Its score is that of its worst string.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import chunks, mix, span_hash

#: Length of the subsequences, their largest span, and the decay per character.
LENGTH, SPAN, DECAY = 4, 6, 0.6
#: Bits of the table of sequence weights.
BITS = 18
#: Longest string scored as one; longer ones are cut into halves that overlap.
LONGEST = 24
#: Characters of one script position: 0 parts strings, 1 is the string's border.
_PARTING, _BORDER, _OTHER = 0, 1, 2
#: Odd multipliers that place a sequence in the table.
_SCALE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_OFFSETS = [c for c in combinations(range(SPAN), LENGTH) if c[0] == 0]


def _char_table() -> np.ndarray:
    """A class for every code unit: white space parts strings, letters stand
    for themselves without case, all else is one class."""
    out = np.full(0x10000, _OTHER, dtype=np.uint16)
    for c in range(0x10000):
        s = chr(c)
        if s.isspace():
            out[c] = _PARTING
        elif s.isalpha():
            low = s.lower()
            out[c] = ord(low[0]) if ord(low[0]) > _OTHER else _OTHER
    return out


_tables: list[np.ndarray] = []


def _classes(text: str) -> np.ndarray:
    if not _tables:
        _tables.append(_char_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _tables[0][np.minimum(codes, 0xFFFF)]


class Strings:
    """The strings of some texts: the words, with runs of three and more
    single letters joined, long ones cut into overlapping pieces.  Equal
    strings are held once; ``text`` and ``index`` say which text has which."""

    def __init__(self, texts: list[str]):
        coded = [_classes(t) for t in texts]
        flat = np.concatenate([np.append(c, np.uint16(_PARTING)) for c in coded]) if coded else np.zeros(0, np.uint16)
        rows = np.repeat(np.arange(len(texts)), [len(c) + 1 for c in coded])
        solid = flat != _PARTING
        begin = np.flatnonzero(solid & ~np.append(False, solid[:-1]))
        end = np.flatnonzero(solid & ~np.append(solid[1:], False)) + 1
        of = rows[begin] if len(begin) else np.zeros(0, np.int64)
        # runs of single letters, in one text, become one string
        single = (end - begin == 1) & (flat[begin] > _OTHER) if len(begin) else np.zeros(0, bool)
        glued = np.zeros(len(begin), dtype=bool)
        glued[1:] = single[1:] & single[:-1] & (of[1:] == of[:-1])
        group = np.cumsum(~glued) - 1
        runs = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        short = glued & (runs[group] < 3)
        group = np.cumsum(~(glued & ~short)) - 1
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        length = np.add.reduceat(end - begin, heads) if len(heads) else np.zeros(0, np.int64)
        keep = np.flatnonzero(solid)
        chars = flat[keep]
        start = np.cumsum(length) - length
        of = of[heads] if len(heads) else of
        # pieces of long strings
        half = LONGEST // 2
        pieces = np.where(length > LONGEST, -(-(length - half) // half), 1)
        string = np.repeat(np.arange(len(length)), pieces)
        nth = np.arange(len(string)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = start[string] + nth * half
        length = np.minimum(np.where(pieces[string] > 1, LONGEST, length[string]), length[string] - nth * half)
        key = span_hash(chars, start, start + length) if len(start) else np.zeros(0, np.uint64)
        _, first, self.index = np.unique(key, return_index=True, return_inverse=True)
        self.text = of[string]
        self.length = length[first]
        self.start = start[first]
        self.chars = chars

    def __len__(self) -> int:
        return len(self.start)

    def spelled(self, which: np.ndarray) -> list[str]:
        """The characters of some strings, the class of others as ``*``."""
        out = []
        for i in which:
            c = self.chars[self.start[i] : self.start[i] + self.length[i]]
            out.append("".join("*" if x == _OTHER else chr(x) for x in c))
        return out

    def padded(self) -> tuple[np.ndarray, np.ndarray]:
        """All strings with their borders in one array, and their starts."""
        size = self.length + 2
        begins = np.cumsum(size) - size
        out = np.full(int(size.sum()), _BORDER, dtype=np.uint64)
        inner = np.repeat(begins + 1 - (np.cumsum(self.length) - self.length), self.length) + np.arange(int(self.length.sum()))
        source = np.repeat(self.start - (np.cumsum(self.length) - self.length), self.length) + np.arange(int(self.length.sum()))
        out[inner] = self.chars[source]
        return out, begins


def _sequences(padded: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """``(valid, table slot, weight)`` of the subsequence that begins at each
    character, one pattern of gaps at a time; ``valid`` where it ends in the
    same string."""
    size = np.diff(np.append(begins, len(padded)))
    left = np.repeat(begins + size, size) - np.arange(len(padded))
    scaled = [padded * m for m in _SCALE]
    for offsets in _OFFSETS:
        n = len(padded) - offsets[-1]
        if n <= 0:
            continue
        code = scaled[0][:n] + scaled[1][offsets[1] : offsets[1] + n]
        code += scaled[2][offsets[2] : offsets[2] + n]
        code += scaled[3][offsets[3] :]
        yield left[:n] > offsets[-1], (code >> np.uint64(64 - BITS)).view(np.int64), DECAY ** (offsets[-1] + 1)


def _norm(length: np.ndarray) -> np.ndarray:
    """Root of the self-kernel of a string of distinct characters."""
    size = np.maximum(LENGTH, length + 2).astype(float)
    total = np.zeros(len(length))
    for offsets in _OFFSETS:
        total += np.maximum(0, size - offsets[-1]) * DECAY ** (2 * (offsets[-1] + 1))
    return np.sqrt(total)


def feature_rows(strings: list[str]) -> np.ndarray:
    """The kernel's feature vectors of some strings, as rows (dense over the
    slots that occur, with the slots as the second value)."""
    held = Strings([])
    coded = [np.array([_OTHER if c == "*" else ord(c) for c in s], dtype=np.uint16) for s in strings]
    held.length = np.array([len(c) for c in coded], dtype=np.int64)
    held.start = np.cumsum(held.length) - held.length
    held.chars = np.concatenate(coded) if coded else np.zeros(0, np.uint16)
    padded, begins = held.padded()
    string = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(padded))))
    rows, slots, weights = [], [], []
    for valid, slot, w in _sequences(padded, begins):
        rows.append(string[: len(valid)][valid])
        slots.append(slot[valid])
        weights.append(np.full(len(rows[-1]), w))
    rows, slots, weights = (np.concatenate(x) for x in (rows, slots, weights))
    return rows, slots, weights / _norm(held.length)[rows]


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised subsequence kernel of two lists of strings."""
    ra, sa, wa = feature_rows(a)
    rb, sb, wb = feature_rows(b)
    used, back = np.unique(sb, return_inverse=True)
    dense_b = np.zeros((len(used), len(b)), dtype=np.float32)
    np.add.at(dense_b, (back, rb), wb)
    # sequences that no string of b has add nothing
    place = np.minimum(np.searchsorted(used, sa), len(used) - 1)
    common = used[place] == sa
    ra, place, wa = ra[common], place[common], wa[common]
    order = np.argsort(ra, kind="stable")
    ra, place, wa = ra[order], place[order], wa[order]
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for at in range(0, len(a), 128):
        lo, hi = np.searchsorted(ra, [at, at + 128])
        dense_a = np.zeros((min(128, len(a) - at), len(used)), dtype=np.float32)
        np.add.at(dense_a, (ra[lo:hi] - at, place[lo:hi]), wa[lo:hi])
        out[at : at + 128] = dense_a @ dense_b
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """``weights``: one per four-character sequence slot; a text's score is the
    logistic of ``slope * (worst string's sum - threshold)``."""

    weights: np.ndarray = field(repr=False)
    threshold: float = 1.0
    slope: float = 4.0
    landmarks: tuple[str, ...] = ()

    def decisions(self, strings: Strings) -> np.ndarray:
        """Decision value of every distinct string."""
        out = np.zeros(len(strings))
        if len(strings):
            padded, begins = strings.padded()
            sums = np.zeros(len(padded))
            for valid, slot, weight in _sequences(padded, begins):
                sums[: len(valid)] += np.where(valid, self.weights[slot], 0.0) * weight
            out = np.add.reduceat(sums, begins) / _norm(strings.length)
        return out

    def worst(self, texts: list[str]) -> np.ndarray:
        """The highest decision value among each text's strings."""
        strings = Strings(texts)
        out = np.full(len(texts), -1.0)
        if len(strings):
            np.maximum.at(out, strings.text, self.decisions(strings)[strings.index])
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.worst(texts) - self.threshold), -30, 30)))


def _noisy(s: str, seed: int) -> list[str]:
    """Gapped and inserted-character spellings of a string."""
    if len(s) < 4:
        return []
    at = 1 + seed % (len(s) - 1)
    letter = "aeioulnrst"[seed % 10]
    return [s[:at] + "*" + s[at:], s[:at] + letter + s[at:], "*".join(s)] if len(s) <= 10 else [s[:at] + "*" + s[at:]]


def _pieces(texts: list[str], size: int = 300) -> Iterator[tuple[int, Strings]]:
    for at in range(0, len(texts), size):
        yield at, Strings(texts[at : at + size])


def _vocabulary(texts: list[str]) -> dict[str, int]:
    """The distinct strings of some texts and their counts."""
    found: Counter[str] = Counter()
    for _, strings in _pieces(texts):
        count = np.bincount(strings.index, minlength=len(strings)).tolist()
        found.update(dict(zip(strings.spelled(np.arange(len(strings))), count, strict=True)))
    return found


def _witnesses(toxic: list[str], known: dict[str, int], least: int, each: int) -> list[str]:
    """The strings to blame: of each toxic text, the ``each`` strings that come
    after the most different strings in toxic texts, ``least`` at least, and
    are in no harmless text.  (Rare words of copied texts keep their
    surroundings; insults are found in many.)"""
    before: dict[str, set[str]] = defaultdict(set)
    held: list[set[str]] = []
    for _, strings in _pieces(toxic):
        spelled = strings.spelled(np.arange(len(strings)))
        of: list[set[str]] = [set() for _ in range(int(strings.text.max(initial=-1)) + 1)]
        last, last_text = "", -1
        for t, k in zip(strings.text.tolist(), strings.index.tolist(), strict=True):
            word = spelled[k]
            if word not in known and len(word) > 1:
                before[word].add(last if t == last_text else "")
                of[t].add(word)
            last, last_text = word, t
        held += of
    picked: Counter[str] = Counter()
    for words in held:
        some = sorted((w for w in words if len(before[w]) >= least), key=lambda w: (-len(before[w]), w))
        picked.update(some[:each])
    return sorted(picked, key=lambda w: (-len(before[w]), w))


def _fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(x))
    penalty[-1] = 1e-9

    def loss(v: np.ndarray) -> float:
        return float((weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum() + (penalty * v * v).sum())

    now = loss(w)
    for _ in range(rounds):
        active = 1 - y * (x @ w) > 0
        if not active.any():
            break
        a, ya, wa = x[active], y[active], weight[active]
        grad = penalty * w - a.T @ (wa * (ya - a @ w))
        step = np.linalg.solve((a.T * wa) @ a + np.diag(penalty + 1e-8), grad)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        new = loss(w - size * step)
        w = w - size * step
        if now - new < 1e-7 * max(1.0, now):
            break
        now = new
    return w[:-1], float(w[-1])


def _highest(model: ToxicityModel, texts: list[str], most: int) -> list[str]:
    """The strings of some texts that the machine scores highest."""
    found: dict[str, float] = {}
    for _, strings in _pieces(texts):
        value = model.decisions(strings)
        top = np.argsort(-value, kind="stable")[:most]
        found.update(zip(strings.spelled(top), value[top].tolist(), strict=True))
    return sorted(found, key=lambda w: (-found[w], w))[:most]


def _worst(model: ToxicityModel, texts: list[str]) -> np.ndarray:
    return np.concatenate([model.worst(texts[at : at + 300]) for at in range(0, len(texts), 300)])


def train(
    toxic: list[str], harmless: list[str], landmarks: int = 640, rounds: int = 5, least: int = 3, each: int = 3, hard: int = 1200
) -> ToxicityModel:
    """Fit the machine on texts labelled toxic and harmless.  Every fourth
    harmless text is kept for the threshold."""
    none = ToxicityModel(np.zeros(1 << BITS), threshold=1.0)
    toxic, harmless = sorted(set(toxic)), sorted(set(harmless))
    seen = [t for i, t in enumerate(harmless) if i % 4] or harmless
    unseen = harmless[::4]
    known = _vocabulary(seen)
    positives = _witnesses(toxic, known, least, each) if harmless else []
    if not positives:
        return none
    spread = [n for i, s in enumerate(positives[:200]) for n in _noisy(s, i)]
    words = sorted(known)
    mixed = sorted(words, key=lambda w: zlib.crc32(w.encode()))[: 2 * landmarks]
    heavy = sorted(words, key=lambda w: (-known[w], w))[:landmarks]
    negatives = list(dict.fromkeys([*mixed, *heavy]))
    model = none
    for turn in range(rounds):
        ours = positives[:: max(1, -(-len(positives) // (landmarks // 2)))]
        theirs = negatives[: landmarks - len(ours)]
        marks = list(dict.fromkeys([*ours, *theirs]))
        values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
        keep = values > 1e-6 * values[-1]
        root = vectors[:, keep] / np.sqrt(values[keep])
        y = np.array([1.0] * (len(positives) + len(spread)) + [-1.0] * len(negatives))
        weight = np.where(y > 0, len(negatives) / (len(positives) + len(spread)), 1.0)
        weight[len(positives) : len(positives) + len(spread)] *= 0.2
        w, bias = _fit_svm(kernel([*positives, *spread, *negatives], marks).astype(np.float64) @ root, y, weight)
        alpha = root @ w
        rows, slots, weights = feature_rows(marks)
        table = np.bincount(slots, weights=weights * alpha[rows], minlength=1 << BITS)
        model = ToxicityModel(table, threshold=-bias, landmarks=tuple(marks))
        if turn + 1 < rounds:  # the hardest harmless strings come first
            negatives = list(dict.fromkeys([*_highest(model, seen, hard), *negatives]))
    # the threshold that parts the texts best, wrong alarms counting more
    good, bad = np.sort(_worst(model, unseen)), np.sort(_worst(model, toxic))
    cuts = np.unique(np.concatenate([good, bad]))
    middle = np.append((cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 1)
    wrong = 4 * (len(good) - np.searchsorted(good, middle)) / len(good) + np.searchsorted(bad, middle) / len(bad)
    best = middle[wrong <= wrong.min() + 1e-12]
    between = np.quantile(bad, 0.5) - np.quantile(good, 0.5)
    return ToxicityModel(table, float(best[len(best) // 2]), float(6 / max(1e-3, between)), tuple(marks))


def labelled_sample(docs: DataFrame, labels: DataFrame, n_toxic: int, n_harmless: int) -> DataFrame:
    """``(toxic, text)`` of at most ``n_toxic`` toxic and ``n_harmless`` harmless
    documents, picked by a hash of the id; conflicting labels are left out."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high")
    picked = None
    for kind, n in ((0, n_harmless), (1, n_toxic)):
        some = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select(F.col("doc_id").alias("_id"), "toxic")
        picked = some if picked is None else picked.unionAll(some)
    # so many ids at most; one text for each
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, n_toxic: int = 1500, n_harmless: int = 6000, **parameters) -> ToxicityModel:
    """Train on a bounded sample of the labelled rows: ``n_toxic`` and
    ``n_harmless`` documents at most, in one task on an executor; the driver
    gets the weights alone.  Without both labels nothing is toxic."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[bool, list[str]] = {False: [], True: []}
        for batch in batches:
            for kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts[kind == 1].append(text or "")
        m = train(texts[True], texts[False], **parameters)
        row = {"weights": m.weights.tobytes(), "threshold": m.threshold, "slope": m.slope, "landmarks": list(m.landmarks)}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("weights", pa.binary()), ("threshold", pa.float64()), ("slope", pa.float64()), ("landmarks", pa.list_(pa.string()))]))

    sample = labelled_sample(docs, labels, n_toxic, n_harmless).repartition(1)
    rows = sample.mapInArrow(task, "weights binary, threshold double, slope double, landmarks array<string>").collect()
    if not rows:
        return ToxicityModel(np.zeros(1 << BITS))
    r = rows[0]
    return ToxicityModel(np.frombuffer(r["weights"], dtype=np.float64), r["threshold"], r["slope"], tuple(r["landmarks"]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` of every whole text.

    A null or empty text has no strings and the lowest score.  Only the text
    is looked at.  A narrow map; memory is bounded by the longest text.  The new
    columns replace columns of their names; an empty table stays empty.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    kept = docs.select(*rest)
    schema = kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    place = rest.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(place)
            scores = np.zeros(batch.num_rows)
            for a, b, _, _ in chunks(text, 4 << 20):
                scores[a:b] = model.scores([t or "" for t in text[a:b].to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=[*rest, "score", "predicted"])

    return kept.mapInArrow(run, schema)


def held_out(doc_id) -> F.Column:
    """Whether a document's label is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Fit on the labels that are not held out, score every row of ``docs``."""
    return score(docs, fit(docs, labels.where(~held_out(F.col("doc_id"))), **parameters))
