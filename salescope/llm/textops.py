"""Words and word hashes of Arrow string columns, as numpy arrays.

The separators of every word rule used here are ASCII, so words are found in
the UTF-8 bytes directly.  Batches are cut into chunks of about a megabyte of
whole rows, which bounds the memory of a task by its longest text.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(int(_STEP), -1, 1 << 64))


def table(chars: str = "", ranges: tuple[tuple[int, int], ...] = ()) -> np.ndarray:
    """A 256-entry truth table of byte values."""
    out = np.zeros(256, dtype=bool)
    for c in chars:
        out[ord(c)] = True
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Bytes of words that white space separates: all but 0x20 and 0x09-0x0D.
SPACED = ~table(" ", ((0x09, 0x0D),))
#: Bytes of letters, digits and everything beyond ASCII.
ALNUM = table("", ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))
IDENTITY = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, other bytes unchanged.
LOWER = IDENTITY.copy()
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        full = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        full[0] = 1
        have = np.cumprod(full, dtype=np.uint64)
        if len(have) == CHUNK + 1:  # those of a longer text don't stay
            _powers[name] = have
    return have[:n]


def release() -> None:
    """Give free memory back to the system: a worker outlives its task, and
    what one stage has freed would count against the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not in every C library
        ctypes.CDLL(None).malloc_trim(0)


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for each span (prefix sums of a
    polynomial, shifted back by the inverse power)."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power("p", _STEP, len(values)), out=sums[1:])
    inverse = _power("i", _INV, len(values) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array; a null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    if array.null_count:
        array = pc.fill_null(array, "")
    buffers = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(array: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets from 0)`` of whole rows."""
    data, offsets = raw(array)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    release()


class Words:
    """The words of a chunk: byte spans, hashes, and the words of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, fold: np.ndarray = IDENTITY):
        self.folded = fold[data]
        mark = letters[data]
        before = np.zeros(len(mark), dtype=bool)
        before[1:] = mark[:-1]
        after = np.zeros(len(mark), dtype=bool)
        after[:-1] = mark[1:]
        full = offsets[1:] > offsets[:-1]
        before[offsets[:-1][full]] = False
        after[offsets[1:][full] - 1] = False
        self.mark = mark
        self.starts = np.flatnonzero(mark & ~before)
        self.ends = np.flatnonzero(mark & ~after) + 1
        #: Row r has the words first[r] to first[r + 1].
        self.first = np.searchsorted(self.starts, offsets)
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = span_hash(self.folded, self.starts, self.ends)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each word on, and whether they lie in
        one row; shorter than the word array by ``k - 1``."""
        return windows(self.hash, self.rows, k)


def windows(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = max(0, len(hashes) - k + 1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * _ODD + hashes[j : j + n]
    return mix(total), rows[:n] == rows[k - 1 : k - 1 + n]


def sequence_hash(hashes: np.ndarray) -> int:
    """Hash of a whole word sequence, apart from any window's."""
    total = int(len(hashes)) + 0x51ED270B
    for h in hashes:
        total = (total * int(_ODD) + int(h)) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([total], dtype=np.uint64))[0])
