"""Conflict-constrained best-fit packing of documents into bins.

Documents longer than a bin are cut into full bins and a remainder.  The
pieces are dealt by hash to groups of bounded size, so that a hot source or a
large group of copies is spread evenly; each group packs its pieces in order
of falling size.  Its open bins are held in order of their residual room, each
with two bitmaps: the sources whose quota it has used up, and the duplicate
clusters it holds.  The successor search starts at the first bin with enough
room and goes on until it meets a compatible one, which is the tightest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.copies import counted, expanded

class Bins:
    """Open bins by rising residual (oldest first among equals), with the
    bitmaps in arrays beside it."""

    def __init__(self, quota: int):
        self.quota = quota
        self.n = self.resume = 0
        room = 1024
        self.residual = np.zeros(room, dtype=np.int64)
        self.bin = np.zeros(room, dtype=np.int64)
        self.full_sources = np.zeros(room, dtype=np.uint64)
        self.clusters = np.zeros(room, dtype=np.uint64)
        #: Exact contents, asked where a bitmap's shared bit is set.
        self.held: list[tuple[dict, set]] = []

    def _compatible(self, b: int, source: object, cluster: object) -> bool:
        sources, clusters = self.held[b]
        return sources.get(source, 0) < self.quota and (cluster is None or cluster not in clusters)

    def find(self, size: int, source: object, cluster: object, source_bit: np.uint64, cluster_bit: np.uint64, start: int = 0) -> int:
        """Place of the tightest compatible bin from place ``start`` on, or -1."""
        at = max(start, int(np.searchsorted(self.residual[: self.n], size)))
        step = 32
        while at < self.n:
            to = min(self.n, at + step)
            clear = ((self.full_sources[at:to] & source_bit) | (self.clusters[at:to] & cluster_bit)) == 0
            first = int(np.argmax(clear)) if clear.any() else to - at
            for i in range(at, at + first):
                if self._compatible(int(self.bin[i]), source, cluster):
                    return i
            if first < to - at:
                return at + first
            at, step = to, step * 2
        return -1

    def _move(self, i: int, j: int) -> None:
        """Take the entry at ``i`` to place ``j`` (``j <= i``)."""
        for a in (self.residual, self.bin, self.full_sources, self.clusters):
            x = a[i].copy()
            a[j + 1 : i + 1] = a[j:i].copy()
            a[j] = x

    def put(self, i: int, size: int, capacity: int, source: object, cluster: object, source_bit: np.uint64, cluster_bit: np.uint64) -> int:
        """Put a piece into the bin at place ``i``, or into a new one; the bin.
        Afterwards no bin before ``self.resume`` takes another such piece."""
        if i < 0:
            if self.n == len(self.residual):
                for name in ("residual", "bin", "full_sources", "clusters"):
                    a = getattr(self, name)
                    setattr(self, name, np.concatenate([a, np.zeros_like(a)]))
            i = self.n
            self.n += 1
            self.residual[i], self.bin[i], self.full_sources[i], self.clusters[i] = capacity, len(self.held), 0, 0
            self.held.append(({}, set()))
        b = int(self.bin[i])
        sources, clusters = self.held[b]
        sources[source] = sources.get(source, 0) + 1
        if sources[source] >= self.quota:
            self.full_sources[i] |= source_bit
        if cluster is not None:
            clusters.add(cluster)
            self.clusters[i] |= cluster_bit
        left = int(self.residual[i]) - size
        # among equal residuals the older bin comes first
        j = int(np.searchsorted(self.residual[:i], left))
        while j < i and self.residual[j] == left and self.bin[j] < b:
            j += 1
        self.residual[i] = left
        self._move(i, j)
        # whatever was passed over stays incompatible with such a piece, and
        # so does the bin that has its cluster now
        self.resume = i + 1 if cluster is not None else j
        if left == 0:  # a full bin takes nothing
            self.resume = i if cluster is not None else j
            for a in (self.residual, self.bin, self.full_sources, self.clusters):
                a[j : self.n - 1] = a[j + 1 : self.n].copy()
            self.n -= 1
        return b


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, quota: int) -> list[int]:
    """Bin of each piece, in the given order.  A cluster of None conflicts with
    nothing; a bin takes a cluster once and ``quota`` pieces of a source."""
    bins = Bins(quota)
    source_bits = {s: np.uint64(1) << np.uint64(k % 64) for k, s in enumerate(dict.fromkeys(sources))}
    cluster_bits = {c: np.uint64(1) << np.uint64(k % 64) for k, c in enumerate(dict.fromkeys(clusters))}
    cluster_bits[None] = np.uint64(0)
    out, last = [], None
    for piece in zip(sizes, sources, clusters, strict=True):
        size, source, cluster = piece
        bits = source_bits[source], cluster_bits[cluster]
        # a piece like the one before goes on where its search ended
        at = bins.find(size, source, cluster, *bits, bins.resume if piece == last else 0)
        out.append(bins.put(at, size, capacity, source, cluster, *bits))
        last = piece
    return out


def pack(docs: DataFrame, capacity: int = 16_384, quota: int = 3, group_rows: int = 8192) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text, source) with their bins.

    Sizes are UTF-8 bytes (null or empty text: none).  A bin holds at most
    ``capacity`` bytes, ``quota`` pieces of one source and one piece of each
    duplicate cluster (rows of equal texts); full pieces of a long text have
    bins of their own.  Returns doc_id, source, piece (from 0), offset and size
    in bytes, bin (a name unique in the result) and position in the bin.  A row
    without text is a piece of no bytes and needs a place too.  Repeated rows
    are rows of their own; an empty table gives an empty result.
    """
    rows = docs.count()
    groups = max(1, -(-rows // group_rows))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    slim = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        size.alias("bytes"),
        F.when(size > 0, F.xxhash64("text")).alias("cluster"),
    )
    # hashed by document and copy, so that sources, copies and rows that repeat
    # are spread over the groups; equal rows are numbered by their count
    slim = expanded(counted(slim, "n"), "n", "copy")
    slim = slim.withColumn("grp", F.pmod(F.xxhash64("doc_id", "source", "cluster", "copy"), F.lit(groups)).cast("int")).drop("copy")
    schema = slim.select("doc_id", "source").withColumns(
        {"piece": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "size": F.lit(0).cast("long"), "bin": F.lit(""), "position": F.lit(0).cast("long")}
    ).schema

    def run(key: tuple, found: pa.Table) -> pa.Table:
        keys = [(c, "ascending") for c in ("doc_id", "source", "cluster", "bytes")]
        found = found.take(pc.sort_indices(found, sort_keys=keys, null_placement="at_start"))
        whole = found["bytes"].to_numpy()
        full = whole // capacity
        rest = whole - full * capacity
        pieces = full + ((rest > 0) | (full == 0))
        at = np.repeat(np.arange(len(whole)), pieces)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        sizes = np.where(nth < full[at], capacity, rest[at])
        order = np.argsort(-sizes, kind="stable")
        sources, clusters = (found[c].take(pa.array(at[order])).to_pylist() for c in ("source", "cluster"))
        bins = np.zeros(len(at), dtype=np.int64)
        bins[order] = best_fit(sizes[order].tolist(), sources, clusters, capacity, quota)
        rank = np.argsort(order, kind="stable")
        by_bin = np.lexsort((rank, bins))
        starts = np.flatnonzero(np.diff(bins[by_bin], prepend=-1))
        position = np.zeros(len(at), dtype=np.int64)
        position[by_bin] = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        picked = found.select(["doc_id", "source"]).take(pa.array(at))
        names = pa.array([f"{key[0].as_py()}-{b}" for b in bins], pa.string())
        made = [pa.array(nth), pa.array(nth * capacity), pa.array(sizes), names, pa.array(position)]
        return pa.Table.from_arrays([*picked.columns, *made], names=schema.names)

    return slim.groupBy("grp").applyInArrow(run, schema)
