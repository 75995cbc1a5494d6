"""Sharding by a k-d tree over text metadata, in DataFrame operations only.

The points of the tree are the documents, weighted by their bytes.  A node is
split at the weighted median along the dimension in which it is widest, until
its leaves reach the target bytes.  The medians of all nodes of a level are
found together and exactly: the weights are summed by the leading bits of the
position, the interval that holds the median is opened up, and so on down to
single positions.  Only one row per node reaches the driver.

All dimensions are taken from the text alone and its checksum breaks ties, so
equal texts share a position, and with it a shard, and every row finds its
shard from its own columns: the documents are not shuffled for it.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.copies import counted, expanded
from salescope.llm.store import materialise

#: Bits of a position that one pass resolves, from the top.
_PASSES = (15, 16, 16, 16)
_SCALE = (1 << 31) - 1


def _of(values: dict[int, int], key: Column) -> Column:
    """Look a node's value up (as many entries as nodes)."""
    pairs = [F.lit(x).cast("long") for x in chain.from_iterable(values.items())]
    return F.element_at(F.create_map(*pairs), key.cast("long"))


def _points(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    size, length = F.octet_length(text).cast("long"), F.length(text)
    lines = F.length(F.translate(text, "\n", "")) - length
    return docs.select(
        "doc_id",
        (size + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.log2(size + 1.0).alias("x0"),
        F.when(length > 0, size / length).otherwise(F.lit(1.0)).alias("x1"),
        F.when(length > 0, -lines / length).otherwise(F.lit(0.0)).alias("x2"),
        F.lit(0).alias("node"),
    )


_AXES = ("x0", "x1", "x2")


def _medians(points: DataFrame, wanted: dict[int, float]) -> dict[int, tuple[int, int, int]]:
    """Of each node: the position at which the weight reaches the wanted one,
    and the weight before and up to it."""
    base = dict.fromkeys(wanted, 0)
    before = dict.fromkeys(wanted, 0)
    upto = dict.fromkeys(wanted, 0)
    shift = 63
    rows = points
    for bits in _PASSES:
        shift -= bits
        cell = F.shiftright("place", shift)
        sums = rows.groupBy("node", cell.alias("cell")).agg(F.sum("size").alias("w"))
        # at most 2 ** bits cells in a node
        run = F.sum("w").over(Window.partitionBy("node").orderBy("cell"))
        sums = sums.withColumn("run", run + _of(before, F.col("node")))
        want = F.element_at(F.create_map(*[F.lit(x) for p in wanted.items() for x in p]), F.col("node"))
        hit = sums.where(F.col("run") >= want).groupBy("node").agg(F.min_by(F.struct("cell", "w", "run"), "cell").alias("h"))
        for r in hit.collect():  # one row per node
            base[r["node"]], upto[r["node"]] = r["h"]["cell"], r["h"]["run"]
            before[r["node"]] = r["h"]["run"] - r["h"]["w"]
        rows = points.where(F.shiftright("place", shift) == _of(base, F.col("node")))
    return {n: (base[n], before[n], upto[n]) for n in wanted}


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, bucket_rows: int = 100_000) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 1 (a null text has none);
    ``text_crc32`` is 0 for a null or empty text.  The tree is split until the
    leaves reach ``target_bytes``, or into ``shards`` leaves.  Leaves are as
    near to equal bytes as whole groups of equal texts allow; a group beyond a
    leaf's share takes the leaf alone and the rest is balanced without it.
    ``slot`` numbers the rows of a shard from 0, without gaps, by hashed bucket
    and doc_id; a bucket holds some ``bucket_rows`` different rows, and rows
    that repeat are numbered by their count, so no row is too frequent for a
    task.  Rows that repeat are rows of their own; an empty table gives an empty
    result.
    """
    points = materialise(_points(docs), "points")
    first = points.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("w"), *[F.min(a).alias(f"lo_{a}") for a in _AXES], *[F.max(a).alias(f"hi_{a}") for a in _AXES]).first()
    total = first["w"] or 0
    if shards is None:
        if not target_bytes:
            raise ValueError("give target_bytes or shards")
        shards = max(1, -(-total // target_bytes))
    whole = {a: ((first[f"hi_{a}"] or 0) - (first[f"lo_{a}"] or 0)) or 1.0 for a in _AXES}
    low = {a: first[f"lo_{a}"] or 0.0 for a in _AXES}
    # a node is named by its first shard; here with the shards it is to fill
    nodes = {0: shards}
    while any(n > 1 for n in nodes.values()):
        wide = points.groupBy("node").agg(F.sum("size").alias("w"), *[(F.max(a) - F.min(a)).alias(a) for a in _AXES])
        weight, axis = {}, {}
        for r in wide.collect():  # one row per node
            if nodes.get(r["node"], 1) > 1:
                weight[r["node"]] = r["w"]
                axis[r["node"]] = max(range(len(_AXES)), key=lambda i: (r[_AXES[i]] / whole[_AXES[i]], -i))
        if not weight:
            break
        scaled = [((F.col(a) - low[a]) / whole[a] * _SCALE).cast("long") for a in _AXES]
        along = F.coalesce(_of(axis, F.col("node")), F.lit(0).cast("long"))
        place = F.shiftleft(F.when(along == 0, scaled[0]).when(along == 1, scaled[1]).otherwise(scaled[2]), 32) + F.col("crc")
        placed = points.withColumn("place", place)
        open_ = placed.where(F.col("node").isin(list(weight)))
        found = _medians(open_, {n: float(w) * (nodes[n] // 2) / nodes[n] for n, w in weight.items()})
        cut, right = {}, {}
        for n, w in weight.items():
            at, before, upto = found[n]
            share = w * (nodes[n] // 2) / nodes[n]
            if before and (upto == w or share - before < upto - share):
                at, upto = at - 1, before  # nearer without the median's own group
            if upto == w:
                nodes[n] = 1  # one position: it can't be split
                continue
            left = min(nodes[n] - 1, max(1, round(nodes[n] * upto / w)))
            cut[n], right[n] = at, n + left
            nodes[n], nodes[n + left] = left, nodes[n] - left
        if cut:
            past = F.col("place") > _of(cut, F.col("node"))
            moved = F.when(past, _of(right, F.col("node")).cast("int")).otherwise(F.col("node"))
            points = materialise(placed.withColumn("node", moved).drop("place"), "points")

    # equal rows are one row with their number until their slots are known
    rows = counted(points.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.col("node").alias("shard")), "n")
    buckets = max(1, -(-first["n"] // bucket_rows))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("c"))
    # one row per shard and bucket
    ahead = counts.select("shard", "bucket", (F.sum("c").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("c")).alias("ahead"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    rows = rows.join(ahead, ["shard", "bucket"]).withColumn("start", F.col("ahead") + F.sum("n").over(order) - F.col("n"))
    rows = expanded(rows.select("doc_id", "size", "text_crc32", "shard", "start", "n"), "n", "copy")
    return rows.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("copy")).alias("slot"))
