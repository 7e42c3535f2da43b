"""Sharding by a weighted k-d tree over document metadata.

A node that is to hold k shards is split along its widest metadata dimension
(the range of its rows over the range of all rows) at the weighted quantile
that gives k // 2 of k shares of its bytes to the left side, until every leaf
is one shard.  All nodes of a level are split together.  The quantile is found
exactly and without sorting: coordinates are 60-bit integers, read 12 bits at a
time from the top; a round sums the bytes per (node, digit), combined map-side,
a running sum over at most 4096 digits a node names the digit in which the
quantile lies, and the next round looks below that digit only.  The driver
holds the tree: a few numbers per shard.

A coordinate is the dimension's value (32 bits, order preserving for numbers; a
string's CRC) with a hash of the row below it, so that ties, such as one source
that holds a third of all rows, split as finely as anything else.

Slots number a shard's rows without gaps: rows are counted per (shard, bucket
of hashed doc_id), the buckets' running sums are added to the rank within the
bucket, and no task holds a whole shard.  DataFrame functions only.

Cases: a null text has no bytes (its size is 8, its CRC that of no bytes); null
metadata is the lowest value; rows that repeat each other stay together at a
cut; extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skywave.llm.common import stored

OVERHEAD = 8
DIGIT, DIGITS, TIE = 12, 5, 28
DIMENSIONS = ("doc_id", "source", "lang")


def _value(name: str, kind: str, low, high) -> Column:
    """The dimension as an integer of 32 bits."""
    c = F.col(name)
    if kind == "string":
        return F.coalesce(F.crc32(c.cast("binary")), F.lit(0))
    if low is None or low == high:
        return F.lit(0).cast("long")
    scaled = (c.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low)) * F.lit(float((1 << 32) - 1))
    return F.coalesce(F.floor(scaled), F.lit(0)).cast("long")


class Node:
    """A node of the tree: the shards it is to hold, and its cut if it has one."""

    def __init__(self, first: int, shards: int):
        self.first, self.shards = first, shards
        self.dimension = self.cut = self.left = self.right = None

    def expression(self, leaf) -> Column:
        if self.left is None:
            return F.lit(leaf(self))
        return F.when(F.col(self.dimension) <= F.lit(self.cut), self.left.expression(leaf)).otherwise(self.right.expression(leaf))

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()


def _points(docs: DataFrame, dimensions) -> tuple[DataFrame, list[str]]:
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = {k: v for k, v in docs.dtypes if k in dimensions}
    rows = docs.select(F.col("doc_id").alias("k_id"), *(F.col(d).alias(f"k_{d}") for d in kinds),
                       (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = stored(rows)
    numbers = [d for d, k in kinds.items() if k != "string"]
    ends = rows.agg(*(f("k_" + d).alias(f"{n}_{d}") for d in numbers for n, f in (("low", F.min), ("high", F.max))), F.count("*").alias("n")).first()
    tie = F.xxhash64("k_id", "text_crc32").bitwiseAND((1 << TIE) - 1)
    put = lambda v: F.shiftleft(v, TIE).bitwiseOR(tie)
    coordinates = {"c_size": put(F.floor(F.log2("size") * (1 << 26)).cast("long"))}
    for d, kind in kinds.items():
        low, high = (None, None) if kind == "string" else (ends[f"low_{d}"], ends[f"high_{d}"])
        coordinates[f"c_{d}"] = put(_value("k_" + d, kind, low, high))
    return stored(rows.select(F.col("k_id").alias("doc_id"), "size", "text_crc32", *(v.alias(k) for k, v in coordinates.items()))), list(coordinates)


def _cuts(points: DataFrame, nodes: dict[int, Node], goals: dict[int, float], node: Column) -> None:
    """Sets each node's cut to the coordinate at which its left side is nearest to its goal of bytes."""
    along = F.coalesce(*(F.when(F.col("node") == i, F.col(n.dimension)) for i, n in nodes.items()))
    rows = points.select("size", *{n.dimension for n in nodes.values()}, node.alias("node")).filter(F.col("node").isin(list(nodes)))
    rows = rows.select("node", "size", along.alias("at"))
    found = {i: (0, 0) for i in nodes}                    # the prefix so far, and the bytes below it
    for k in range(DIGITS):
        shift = DIGIT * (DIGITS - 1 - k)
        of = lambda j: F.coalesce(*(F.when(F.col("node") == i, F.lit(v[j])) for i, v in found.items()))  # noqa: E731, B023
        here = rows if k == 0 else rows.filter(F.shiftright("at", shift + DIGIT) == of(0))
        sums = here.groupBy("node", F.shiftright("at", shift).alias("prefix")).agg(F.sum("size").alias("s"))
        order = Window.partitionBy("node").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        goal = F.coalesce(*(F.when(F.col("node") == i, F.lit(float(g))) for i, g in goals.items()))
        upto = sums.withColumn("upto", F.sum("s").over(order) + of(1)).filter(F.col("upto") >= goal)
        for r in upto.groupBy("node").agg(F.min(F.struct("upto", "prefix", "s")).alias("m")).collect():   # a row a node
            found[r["node"]] = r["m"]["prefix"], r["m"]["upto"] - r["m"]["s"]
            if k == DIGITS - 1:
                under, over = goals[r["node"]] - found[r["node"]][1], r["m"]["upto"] - goals[r["node"]]
                nodes[r["node"]].cut = r["m"]["prefix"] - (under < over)


def tree(points: DataFrame, coordinates: list[str], shards: int) -> Node:
    root = Node(0, shards)
    whole = None
    while todo := {n.first: n for n in root.leaves() if n.shards > 1}:
        node = root.expression(lambda n: n.first)
        ranges = points.groupBy(node.alias("node")).agg(F.sum("size").alias("size"), *(F.struct(F.min(c), F.max(c)).alias(c) for c in coordinates))
        stats = {r["node"]: r for r in ranges.collect()}   # a row a node
        whole = whole or {c: max(1, stats[0][c][1] - stats[0][c][0]) for c in coordinates if 0 in stats}
        goals = {}
        for i, n in todo.items():
            r = stats.get(i)
            n.dimension = max(coordinates, key=lambda c: (r[c][1] - r[c][0]) / whole[c] if r else 0)
            n.cut = 0
            goals[i] = (r["size"] if r else 0) * (n.shards // 2) / n.shards
        full = {i: n for i, n in todo.items() if i in stats}
        if full:
            _cuts(points, full, goals, node)
        for n in todo.values():
            n.left, n.right = Node(n.first, n.shards // 2), Node(n.first + n.shards // 2, n.shards - n.shards // 2)
    return root


def shards(docs: DataFrame, count: int | None = None, target_bytes: int | None = None, dimensions=DIMENSIONS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); so many shards, or as many as
    the target size asks for."""
    points, coordinates = _points(docs, dimensions)
    n, total = points.agg(F.count("*"), F.sum("size")).first()
    count = count or max(1, -(-(total or 0) // target_bytes))
    shard = tree(points, coordinates, count).expression(lambda node: node.first)
    buckets = max(64, n // (20_000 * count))
    rows = points.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"),
                         F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).alias("bucket"))
    sums = rows.groupBy("shard", "bucket").agg(F.count("*").alias("here"))
    order = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    offset = sums.select("shard", "bucket", (F.sum("here").over(order) - F.col("here")).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (rows.withColumn("rank", rank).join(offset, ["shard", "bucket"])
                .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot")))
