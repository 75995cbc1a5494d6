"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch (runs of space marks with the text that follows)
are held as one ragged numpy array of symbols.  In every round each sequence
applies its lowest-rank pair, all sequences at once; finished sequences leave
the array, and the surviving symbols are counted.  Equal pre-tokens of a batch
are merged once.

The merge order is that of the vocabulary's own library: the best score
first, the leftmost among equals.  A sequence applies several occurrences of
its lowest-rank pair in one round only where that can't change the result: if
no new pair can outrank the merged piece, or if the occurrences are further
apart than the longest piece, which no chain of merges can cross.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import mix, raw, span_hash

SPACE = "▁"
_NONE = np.int32(1 << 30)


class PieceMerger:
    """The merge tables of a byte-fallback BPE model file.

    Raises ``ValueError`` for a model whose pieces cross word borders or whose
    normaliser does more than mark spaces.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        probe = "ﬁ Å 　 \t x"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE) or not model.is_byte(model.piece_to_id("<0x00>")):
            raise ValueError("the model's normaliser must only mark spaces, with byte fallback")
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                pieces[model.id_to_piece(i)] = model.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces must not hold a space mark after other characters")
        symbols = list(dict.fromkeys([*pieces, *(c for p in pieces for c in p)]))
        ids = {p: i for i, p in enumerate(symbols)}
        #: Tokens of a surviving symbol: one, or its bytes if it is no piece.
        self.cost = np.array([1 if p in pieces else len(p.encode()) for p in symbols], dtype=np.int64)
        self.longest = max(map(len, symbols))
        scores = sorted(set(pieces.values()), reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        held: dict[int, int] = {}
        for p in pieces:
            held[rank[pieces[p]]] = held.get(rank[pieces[p]], 0) + (len(p) > 1)
        left, right, merged, ranks = [], [], [], []
        crossing = {r for r, n in held.items() if n > 1}
        for p, score in pieces.items():
            for k in range(1, len(p)):
                x, y = ids.get(p[:k]), ids.get(p[k:])
                if x is None or y is None:
                    continue
                left.append(x)
                right.append(y)
                merged.append(ids[p])
                ranks.append(rank[score])
                for part in (p[:k], p[k:]):
                    if len(part) > 1 and rank[pieces[part]] > rank[score]:
                        crossing.add(rank[pieces[part]])
        #: Ranks all of whose occurrences may merge in one round.
        self.together = np.ones(len(scores), dtype=bool)
        self.together[list(crossing)] = False
        self.chars = np.full(0x110000, -1, dtype=np.int32)
        for c in symbols:
            if len(c) == 1:
                self.chars[ord(c)] = ids[c]
        self.size = len(symbols)
        self._index(np.array(left, np.int64) * self.size + np.array(right, np.int64), np.array(merged, np.int32), np.array(ranks, np.int32))

    def _index(self, keys: np.ndarray, merged: np.ndarray, ranks: np.ndarray) -> None:
        """An open-addressing table of the pairs."""
        self.bits = max(8, int(len(keys) * 4 - 1).bit_length())
        slots = 1 << self.bits
        self.keys = np.full(slots, -1, dtype=np.int64)
        self.entry = np.zeros(slots, dtype=np.int32)
        todo = np.arange(len(keys))
        at = self._slot(keys)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[at[todo]] < 0
            first = np.unique(at[todo[free]], return_index=True)[1]
            placed = todo[free][first]
            self.keys[at[placed]] = keys[placed]
            self.entry[at[placed]] = placed
            todo = todo[~np.isin(todo, placed)]
            at[todo] = (at[todo] + 1) & (slots - 1)
        self.merged, self.ranks = merged, ranks

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank ``_NONE`` if none."""
        keys = left.astype(np.int64) * self.size + right
        rank = np.full(len(keys), _NONE, dtype=np.int32)
        piece = np.zeros(len(keys), dtype=np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        for _ in range(self.probes):
            here = self.keys[at]
            hit = here == keys[todo]
            entry = self.entry[at[hit]]
            rank[todo[hit]] = self.ranks[entry]
            piece[todo[hit]] = self.merged[entry]
            more = ~hit & (here >= 0)
            if not more.any():
                break
            todo, at = todo[more], (at[more] + 1) & ((1 << self.bits) - 1)
        return rank, piece

    def survivors(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each sequence: ``symbols`` from each start to the next."""
        n = len(starts)
        counts = np.zeros(n, dtype=np.int64)
        if not n:
            return counts
        lengths = np.diff(np.append(starts, len(symbols)))
        which = np.repeat(np.arange(n), lengths)
        sym = symbols.astype(np.int32)
        rank = np.full(len(sym), _NONE, dtype=np.int32)
        piece = np.zeros(len(sym), dtype=np.int32)
        inside = np.flatnonzero(which[:-1] == which[1:])
        rank[inside], piece[inside] = self.pairs(sym[inside], sym[inside + 1])
        while len(sym):
            heads = np.flatnonzero(np.diff(which, prepend=-1))
            best = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(sym)))
            if (best == _NONE).any():
                over = np.repeat(best == _NONE, sizes)
                counts += np.bincount(which[over], weights=self.cost[sym[over]], minlength=n).astype(np.int64)
                keep = ~over
                sym, rank, piece, which = sym[keep], rank[keep], piece[keep], which[keep]
                if not len(sym):
                    break
                best, sizes = best[best != _NONE], sizes[best != _NONE]
            lowest = np.repeat(best, sizes)
            at = np.flatnonzero(rank == lowest)
            joint = self.together[lowest[at]]
            same = np.zeros(len(at), dtype=bool)
            same[1:] = which[at[1:]] == which[at[:-1]]
            gap = np.diff(at, prepend=-(1 << 40))
            # of touching occurrences every second one, from the left
            opens = ~same | (gap > 1)
            run = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
            alternate = (at - at[run]) % 2 == 0
            # else the first of each group of occurrences within a piece's reach
            alone = ~same | (gap > self.longest)
            at = at[np.where(joint, alternate, alone)]
            sym[at] = piece[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            sym, rank, piece, which = sym[keep], rank[keep], piece[keep], which[keep]
            changed = np.zeros(len(sym), dtype=bool)
            changed[moved] = True
            changed[moved[moved > 0] - 1] = True
            rank[changed] = _NONE
            changed[:-1] &= which[1:] == which[:-1]
            changed[-1:] = False
            ask = np.flatnonzero(changed)
            rank[ask], piece[ask] = self.pairs(sym[ask], sym[ask + 1])
        return counts

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, without begin and end tokens."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(t) for t in marked], dtype=np.int64)
        out = np.zeros(len(texts), dtype=np.int64)
        if not len(codes):
            return out
        sym = self.chars[codes]
        known = sym >= 0
        row = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        strange = np.flatnonzero(~known)
        c = codes[strange]
        out += np.bincount(row[strange], weights=1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), minlength=len(texts)).astype(np.int64)
        space = codes == ord(SPACE)
        fresh = np.ones(len(codes), dtype=bool)
        fresh[1:] = ~known[:-1] | (row[1:] != row[:-1]) | (space[1:] & ~space[:-1])
        starts = np.flatnonzero(fresh & known)
        stop = np.append(fresh[1:] | ~known[1:], True)
        ends = np.flatnonzero(stop & known) + 1
        hashes = span_hash(sym + 1, starts, ends)
        _, pick, back = np.unique(hashes, return_index=True, return_inverse=True)
        lengths = ends[pick] - starts[pick]
        begins = np.cumsum(lengths) - lengths
        flat = np.repeat(starts[pick] - begins, lengths) + np.arange(int(lengths.sum()))
        counted = self.survivors(sym[flat], begins)
        out += np.bincount(row[starts], weights=counted[back], minlength=len(texts)).astype(np.int64)
        return out


_mergers: dict[str, PieceMerger] = {}


def merger(model_file: str) -> PieceMerger:
    """The tables of a model file, read once per Python worker."""
    if model_file not in _mergers:
        _mergers[model_file] = PieceMerger(model_file)
    return _mergers[model_file]


def default_model() -> str:
    """The model file of the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, limit: int = 4096, model_file: str | None = None, batch_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` (a ``text`` column and any others but the new names) with
    ``n_bytes``, ``n_tokens`` and ``over_limit``; a null text counts as empty.

    ``model_file`` must be readable on the executors; by default they look up
    their own copy.  A narrow map: no shuffle, and memory bounded by the
    longest text and ``batch_bytes``.  The new columns replace columns of
    their names; an empty table gives an empty result.
    """
    new = ("n_bytes", "n_tokens", "over_limit")
    rest = [c for c in docs.columns if c not in new and c != "text"]
    source = docs.select(*rest, "text")
    schema = docs.select(*rest).withColumns(
        {"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long"), "over_limit": F.lit(True)}
    ).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = merger(model_file or default_model())
        for batch in batches:
            text = batch.column(len(rest))
            _, offsets = raw(text)
            n_bytes = np.diff(offsets)
            n_tokens = np.zeros(len(n_bytes), dtype=np.int64)
            at = 0
            while at < len(n_bytes):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + batch_bytes, side="right")) - 1)
                n_tokens[at:to] = tables.count([t or "" for t in text[at:to].to_pylist()])
                at = to
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(rest))], pa.array(n_bytes.astype(np.int64)), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=[*rest, *new],
            )

    return source.mapInArrow(count, schema)


def counted(rows: pd.Series, model_file: str | None = None) -> pd.Series:
    """Token counts of a pandas series of texts."""
    return pd.Series(merger(model_file or default_model()).count([t if isinstance(t, str) else "" for t in rows]), index=rows.index)
