"""Helpers that several operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave.session import checkpoint_root

#: Bits of a bitmap filter: 4 MB, whatever the input.
BITMAP_LOG2 = 25
#: Bytes of an Arrow batch that a task works on.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder: later plans start from there,
    whichever executors have gone by then."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes: a task's memory then doesn't
    depend on how long the texts are."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def bits_of(ids: Column, log2: int = BITMAP_LOG2) -> Column:
    return F.pmod(F.xxhash64(ids), F.lit(1 << log2))


def bitmap(rows: DataFrame, bit: Column, log2: int = BITMAP_LOG2):
    """A broadcast bitmap of bit numbers below 2**log2.  Its size is fixed, so it
    can be sent to every task at any input size; it only lets more rows pass as
    it fills, and whoever uses it joins exactly afterwards."""
    found = (rows.select((bit + 1).alias("bit"))            # the functions count from 1
                 .groupBy(F.bitmap_bucket_number("bit").alias("n"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    whole = np.zeros(1 << (log2 - 3), np.uint8)
    for r in found:                                       # at most 2**log2 / 32768 rows of 4 KB
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["n"] - 1) * 4096
        whole[at:at + len(part)] = part
    return rows.sparkSession.sparkContext.broadcast(whole)


def in_bitmap(whole: np.ndarray, bit: np.ndarray) -> np.ndarray:
    bit = np.asarray(bit, np.int64)
    return (whole[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


#: Links that one task joins by union-find (16 bytes each, and a dictionary of their vertices).
TOGETHER = 1 << 17


def components(links: DataFrame, a: str = "a", b: str = "b", together: int = TOGETHER) -> DataFrame:
    """Connected components of undirected links: (v, root), root the smallest vertex
    of v's component, for every vertex but the roots themselves.

    Up to ``together`` links are joined in one task; of more, star contraction
    finds the components in as many tasks as there are partitions."""
    a_, b_ = F.col("a"), F.col("b")
    e = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
               .select(F.greatest(a_, b_).alias("a"), F.least(a_, b_).alias("b")))
    if e.count() <= together:
        return stored(e.repartition(1).transform(mapped, _joined, "v long, root long"))
    return _stars(e)


def _joined(batches):
    up: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while up.get(top, top) != top:
            top = up[top]
        while up.get(x, x) != top:
            up[x], x = top, up[x]
        return top

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(x), find(y)
            up[max(x, y)] = up[min(x, y)] = min(x, y)
    v = [x for x in up if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array([find(x) for x in v], pa.int64())], ["v", "root"])


def _stars(e: DataFrame) -> DataFrame:
    """Components of links (a > b) by alternating large-star and small-star steps.

    Each step aggregates per vertex (combined map-side) and joins the minimum
    back; the work of a round is linear in the links, a hub's rows can be split
    by AQE, and only two numbers a round reach the driver."""
    a_, b_ = F.col("a"), F.col("b")
    before = None
    while True:
        both = e.unionByName(e.select(b_.alias("a"), a_.alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(b_.alias("a"), F.col("m").alias("b"))
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(b_.alias("a"), F.col("m").alias("b"))
        e = stored(small.unionByName(low2.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before or not now[0]:
            return e.select(a_.alias("v"), b_.alias("root"))
        before = now
