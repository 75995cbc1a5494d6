"""Near-duplicate documents by chosen-path set similarity join.

1. *Sets and sketches.*  Each text becomes its set of hashed word shingles, and
   the smallest hash of each of 128 hash ranges becomes a minwise token.
   Texts with equal sets are one class from here on, so copies cost nothing.
2. *Branching.*  In every tree a class is sent to the children named by its
   selected tokens: a token is selected if a hash of (node, token) falls under
   ``1 / (similarity * tokens)``.  Classes as similar as the threshold share one
   child on average at every level; unlike ones part.  Nodes of one class
   vanish, small nodes are leaves, larger ones branch again, ``levels`` times.
   ``trees`` independent trees reach the target recall.
3. *Exhaustive comparison* inside leaves, of the sketches, keeping a spanning
   forest of the pairs that may reach the threshold (a pair already joined by
   others is not compared).  A node still too large is cut into blocks that
   share some pivots; what the pivots did not join is then compared with every
   block, so no pair is left out and no group is gathered in one task.
4. *Confirmation.*  The components of these candidates are compared again on
   their full sets, in the same way, and the components of the confirmed links
   are the result.  The smallest document id of a component stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.graph import components
from salescope.llm.store import materialise
from salescope.llm.textops import LOWER, SPACED, Words, chunks, mix, sequence_hash

BINS = 128
#: Standard deviations of the sketch estimate that a candidate may fall short.
_SLACK = 4.5
_SEED = np.uint64(0x632BE59BD9B4E019)


# --- sets and sketches --------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a chunk.  Fewer than
    ``k`` words make one shingle; no words an empty set."""
    words = Words(data, offsets, SPACED, LOWER)
    wins, _ = words.windows(k)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= k:
            s = np.sort(wins[a : b - k + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif b > a:
            out.append(np.array([sequence_hash(words.hash[a:b])], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_key(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        first, second = mix(s ^ _SEED).sum(dtype=np.uint64), mix(s + _SEED).sum(dtype=np.uint64)
    return int(first).to_bytes(8, "big") + int(second).to_bytes(8, "big")


def sketch(s: np.ndarray) -> np.ndarray:
    """The smallest hash of each range as a 32-bit token; 0: no hash in it."""
    out = np.zeros(BINS, dtype=np.uint32)
    if len(s):
        where = (s >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        out[where[first]] = (s[first] & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)
    return out


def _row() -> F.Column:
    """A name for a document's row: the same for rows that repeat it."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64("text")))


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    source = docs.select("doc_id", _row().alias("row"), "text")
    schema = source.drop("text").withColumns({"n": F.lit(0).cast("long"), "key": F.lit(b""), "sketch": F.lit(b"")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, _, data, offsets in chunks(batch.column(2)) for s in shingle_sets(data, offsets, k)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                ],
                names=["doc_id", "row", "n", "key", "sketch"],
            )

    return source.mapInArrow(run, schema)


# --- branching ------------------------------------------------------------------


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def select_children(tokens: np.ndarray, nodes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and child node of every selected token of a token matrix."""
    seeded = (tokens.astype(np.uint64) + (np.arange(BINS, dtype=np.uint64) << np.uint64(32))) ^ mix(nodes + _SEED)[:, None]
    draw = mix(seeded)
    held = np.maximum(1, (tokens != 0).sum(axis=1))
    under = np.minimum(2.0**64 - 2048, 2.0**64 / (similarity * held)).astype(np.uint64)
    rows, cols = np.nonzero((draw < under[:, None]) & (tokens != 0))
    return rows, mix(draw[rows, cols] + _SEED)


def _children(members: DataFrame, similarity: float, trees: int) -> DataFrame:
    """``(g, cid)``: from the root of each tree, or from nodes ``g`` if given."""
    rooted = "g" not in members.columns
    source = members.select("cid", "sketch") if rooted else members.select("cid", "sketch", "g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                cid = batch.column(0).to_numpy()
                tokens = _matrix(batch.column(1), np.uint32)
                for tree in range(trees if rooted else 1):
                    nodes = np.full(len(cid), tree + 1, np.uint64) if rooted else batch.column(2).to_numpy().astype(np.uint64)
                    rows, child = select_children(tokens, nodes, similarity)
                    yield pa.RecordBatch.from_arrays([pa.array(child.astype(np.int64)), pa.array(cid[rows])], names=["g", "cid"])

    return source.mapInArrow(run, "g long, cid long").distinct() if not rooted else source.mapInArrow(run, "g long, cid long")


# --- exhaustive comparison in bounded groups ---------------------------------------


def _may_reach(one: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sketches allow the similarity, within the slack."""
    held = ((others != 0) | (one != 0)).sum(axis=1)
    agree = ((others == one) & (one != 0)).sum(axis=1)
    return agree >= similarity * held - _SLACK * np.sqrt(similarity * (1 - similarity) * held)


class SketchLinks:
    """Candidate links of a group, by 8-bit sketches."""

    columns = ("sketch8",)

    def __init__(self, similarity: float):
        self.similarity = similarity

    def load(self, payload: list[pa.Array]) -> np.ndarray:
        return _matrix(payload[0], np.uint8)

    def linked(self, tokens: np.ndarray, i: int, js: np.ndarray) -> Iterator[int]:
        yield from js[_may_reach(tokens[i], tokens[js], self.similarity)]


class SetLinks:
    """Confirmed links of a group, on the full sets of its texts."""

    columns = ("text",)

    def __init__(self, k: int, percent: int):
        self.k, self.percent = k, percent

    def load(self, payload: list[pa.Array]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        sets = [s for _, _, data, offsets in chunks(payload[0]) for s in shingle_sets(data, offsets, self.k)]
        return sets, np.array([len(s) for s in sets]), np.array([sketch(s) for s in sets]).reshape(-1, BINS)

    def linked(self, loaded: tuple, i: int, js: np.ndarray) -> Iterator[int]:
        sets, sizes, tokens = loaded
        low, high = np.minimum(sizes[i], sizes[js]), np.maximum(sizes[i], sizes[js])
        js = js[(low > 0) & (100 * low >= self.percent * high)]
        for j in js[_may_reach(tokens[i], tokens[js], self.percent / 100)]:
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= self.percent * (len(sets[i]) + len(sets[j]) - common):
                yield j


def spanning(rules, cids: np.ndarray, labels: np.ndarray, payload: list[pa.Array], home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the components that the links make of a group's classes.
    Pairs of one label, and pairs of two rows at home, are not compared."""
    loaded = rules.load(payload)
    _, comp = np.unique(labels, return_inverse=True)
    started = comp.copy()
    for i in range(len(cids) - 1):
        js = i + 1 + np.flatnonzero((comp[i + 1 :] != comp[i]) & ~(home[i + 1 :] & home[i]))
        if len(js):
            for j in rules.linked(loaded, i, js):
                if comp[j] != comp[i]:
                    comp[comp == comp[j]] = comp[i]
    order = np.lexsort((cids, comp))
    first = np.append(True, comp[order[1:]] != comp[order[:-1]])
    root = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    moved = (cids[order] != cids[root]) & (started[order] != started[root])
    return cids[order][moved], cids[root][moved]


def _compare(rows: DataFrame, attach: Callable[[DataFrame], DataFrame], rules) -> DataFrame:
    """Edges ``(a, b)`` of rows ``(g, part, cid, label, home)``; a group is one
    (g, part), of bounded size.  ``attach`` brings what the rules compare.
    Groups are streamed from sorted partitions, many to a task."""
    names = ["g", "part", "cid", "label", "home", *rules.columns]
    source = attach(rows).select(*names).repartition("g", "part").sortWithinPartitions("g", "part")

    def edges(batch: pa.RecordBatch, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        cut = batch.slice(a, b - a)
        home = np.asarray(cut.column(4).to_numpy(zero_copy_only=False), bool)
        payload = [cut.column(5 + i) for i in range(len(rules.columns))]
        return spanning(rules, cut.column(2).to_numpy(), cut.column(3).to_numpy(), payload, home)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None

        def settle(batch: pa.RecordBatch, last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch]:
            g, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.append(np.append(0, 1 + np.flatnonzero((g[1:] != g[:-1]) | (part[1:] != part[:-1]))), len(g))
            if not last:
                cuts = cuts[:-1]
            found = [edges(batch, int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1]
            one = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1)]
            out = pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in one], names=["a", "b"])
            return out, batch.slice(int(cuts[-1]))

        for batch in batches:
            if batch.num_rows:
                whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                out, held = settle(whole, False)
                yield out
        if held is not None and held.num_rows:
            yield settle(held, True)[0]

    return source.mapInArrow(run, "a long, b long")


def forest(
    members: DataFrame, attach: Callable[[DataFrame], DataFrame], rules, most: int, most_size: int, pivots: int = 16
) -> DataFrame:
    """Edges of a spanning forest of the links inside each group of
    ``members`` (g, cid, size, and columns that ``attach`` needs).

    Groups of the same members are compared once; groups of at most ``most``
    classes and ``most_size`` of size as they are.  A larger one is cut into
    blocks by hash, each with the group's pivots; classes that this leaves
    outside the group's largest component are compared with every other block.
    All pairs of different components are compared in the end, by tasks of
    bounded size.
    """
    sizes = members.groupBy("g").agg(
        F.count(F.lit(1)).alias("c"),
        F.sum("size").alias("s"),
        F.bit_xor(F.xxhash64("cid")).alias("x"),
        F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"),
    )
    blocks = F.ceil(F.greatest(F.col("c") / most, F.col("s") / most_size)).cast("int")
    sizes = sizes.where("c > 1").groupBy("c", "x", "y").agg(F.min("g").alias("g"), F.max("s").alias("s"))
    sizes = materialise(sizes.select("g", blocks.alias("blocks")), "sizes")
    part = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    rows = materialise(members.join(sizes, "g").withColumns({"part": part, "label": F.col("cid"), "home": F.lit(False)}), "rows")
    large = rows.where("blocks > 1")
    if not large.limit(1).count():
        return materialise(_compare(rows, attach, rules), "links")
    first = large.where(F.col("part") < pivots).groupBy("g", "part").agg(F.min("cid").alias("cid")).select("g", "cid")
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    home = F.col("part")
    pivot = large.join(first, ["g", "cid"], "left_semi").withColumn("to", everywhere).where(F.col("to") != home)
    pivot = pivot.withColumn("part", F.col("to")).drop("to")
    found = materialise(_compare(rows.unionByName(pivot), attach, rules), "links")
    roots = components(found).select(F.col("v").alias("cid"), "root")
    labelled = large.join(roots, "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root")
    counts = labelled.groupBy("g", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("g").agg(F.max_by("label", F.struct("n", "label")).alias("top"))
    labelled = materialise(labelled.join(largest, "g"), "labelled")
    rest = labelled.where("label <> top")
    over = rest.groupBy("g").agg(F.ceil(F.greatest(F.count(F.lit(1)) / most, F.sum("size") / most_size)).cast("int").alias("guests"))
    over = materialise(over, "guests")
    if not over.limit(1).count():
        return found
    visit = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("guests")).cast("int")
    at_home = labelled.join(over, "g").withColumn("guest", F.explode(F.sequence(F.lit(0), F.col("guests") - 1))).withColumn("home", F.lit(True))
    guests = rest.join(over, "g").withColumn("guest", visit).withColumn("part", everywhere)
    both = at_home.unionByName(guests).withColumn("part", F.col("part") * F.col("guests") + F.col("guest"))
    return materialise(found.unionAll(_compare(both, attach, rules)), "links")


# --- the operator --------------------------------------------------------------------


def _components(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    trees: int = 20,
    levels: int = 4,
    leaf: int = 4096,
    leaf_shingles: int = 2_000_000,
) -> tuple[DataFrame, DataFrame]:
    """The sketched rows of ``docs``, and for the key of every class
    ``(key, component_id, first_row)``: the smallest doc_id of its component,
    and the name of the row that has it (null ids last, then by row name)."""
    similarity = percent / 100
    rows = materialise(_sketches(docs, shingle), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    some = rows.where("n > 0").groupBy("key").agg(first.alias("first"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    some = some.select("key", "first.doc_id", "first.row", "n", "sketch", F.monotonically_increasing_id().alias("cid"))
    classes = materialise(some, "classes")

    # one byte of each token, 0 staying 0
    small = classes.select("cid", "sketch").mapInArrow(_small, "cid long, sketch8 binary")
    nodes = _children(classes, similarity, trees)
    leaves = None
    for level in range(1, levels + 1):
        counts = nodes.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        shared = materialise(nodes.join(counts, "g"), f"level{level}")
        last = level == levels or not shared.where(F.col("c") > leaf).limit(1).count()
        part = (shared if last else shared.where(F.col("c") <= leaf)).select("g", "cid")
        leaves = part if leaves is None else leaves.unionAll(part)
        if last:
            break
        nodes = _children(shared.where(F.col("c") > leaf).select("g", "cid").join(classes.select("cid", "sketch"), "cid"), similarity, 1)

    members = leaves.withColumn("size", F.lit(0).cast("long"))
    sketched = forest(members, lambda rows: rows.join(small, "cid"), SketchLinks(similarity), leaf, leaf_shingles)
    held = classes.select(F.col("cid").alias("v"), "row", F.col("n").alias("size"))
    members = components(sketched).join(held, "v").select(F.col("root").alias("g"), F.col("v").alias("cid"), "size", "row")

    def with_texts(rows: DataFrame) -> DataFrame:
        # the members grow with the corpus, so the join is planned alike at
        # every size; rows that repeat a document meet here and are one
        texts = docs.select(_row().alias("row"), "text").join(rows.hint("merge"), "row")
        return texts.dropDuplicates(["row", "g", "part", "cid"])

    linked = components(forest(members, with_texts, SetLinks(shingle, percent), leaf, leaf_shingles))

    ids = linked.join(classes.select(F.col("cid").alias("v"), "doc_id", "row"), "v")
    lowest = ids.groupBy("root").agg(first.alias("lowest"))
    of_class = linked.join(lowest, "root").select(F.col("v").alias("cid"), "lowest")
    named = classes.select("cid", "key", "doc_id", "row").join(of_class, "cid", "left")
    return rows, named.select(
        "key",
        F.coalesce("lowest.doc_id", "doc_id").alias("component_id"),
        F.coalesce("lowest.row", "row").alias("first_row"),
    )


def near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Documents are linked if ``100 * common >= percent * union`` of their
    distinct word shingles (words lower-cased A-Z, parted by white space; fewer
    words than a ``shingle`` make one).  A text without words or null has no
    shingles and is linked with nothing.  ``component_id`` is the smallest
    doc_id reachable; rows that repeat a doc_id are rows of their own.  With
    the defaults a pair at the threshold shares a leaf with a probability over
    0.999.  An empty table gives an empty result.
    """
    rows, named = _components(docs, **parameters)
    out = rows.select("doc_id", "n", "key").join(named, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = _matrix(batch.column(1), np.uint32) if batch.num_rows else np.zeros((0, BINS), np.uint32)
        bytes_ = np.where(tokens == 0, 0, (tokens >> np.uint32(8)) % np.uint32(255) + np.uint32(1)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.tobytes() for t in bytes_], pa.binary())], names=["cid", "sketch8"])


def deduplicate(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, and every row whose
    text has no words.

    Of a group the row of the smallest doc_id stays (null ids last; of several
    texts with that id the one of the lowest row name; of rows that repeat both
    the first by their other columns).  Rows are chosen by id and text, so rows
    of one id, or without one, that differ are judged apart.
    """
    chosen = _components(docs, **parameters)[1].select(F.col("first_row").alias("_row")).distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    same = docs.select(F.struct(*docs.columns).alias("_doc"), order.alias("_order"), _row().alias("_row")).join(chosen, "_row", "left_semi")
    one = same.groupBy("_row").agg(F.min_by("_doc", "_order").alias("_doc")).select("_doc.*")
    wordless = docs.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return one.unionByName(wordless)
