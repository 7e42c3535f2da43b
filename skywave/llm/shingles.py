"""Sets of word shingles, their exact links, and components from candidate buckets.

What the near-duplicate operators share once each has dealt its documents to
buckets by its own keys.  Equal sets are one vertex.  Two vertices link when
their Jaccard similarity is PERCENT / 100 or more; a bucket says that its members
may link, and that all who link share one.  ``connect`` finds the components
without comparing all members of a bucket with each other:

1. Every vertex is compared with one other, the first member with which it
   shares most buckets.  Groups of near copies are connected by that.
2. A bucket whose members are one component by then is done.  In buckets of up
   to FEW members the rest is compared pair by pair, across components.
3. The members of larger ones are compared by their rarest shingles: with the
   shingles of a set in the order of how many of these members have them, two
   that link share one among the first ``n - overlap + 1``, and the first one
   they share lies so early that enough are left behind it.  Members that only
   share what all have don't meet.  This is exact, too.  Again each is first
   compared with a few, the members whose shared shingle comes earliest, and
   with the rest only across what are different components then.

All three compare whole sets, after the operator's own bound.  The counts that
order shingles are kept in 2**SLOTS numbers (4 bytes each), whatever the input;
any order gives the same links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.llm import kernel as K
from skywave.llm.common import bitmap, bits_of, components, in_bitmap, mapped, stored

PERCENT = 80
#: Members of a bucket that are compared pair by pair.
FEW = 6
SLOTS = 18
#: Members with which one of a large bucket is compared before the rest is looked at.
HEADS = 6


def shingle_sets(column, k: int):
    """(row, distinct shingle hashes in ascending order) of each text."""
    for first, _, buf, bounds in K.texts(column):
        w, at, _, _ = K.words(buf, bounds, K.NOT_SPACE)
        g = K.grams(w, k)
        for i in range(len(bounds) - 1):
            a, b = int(at[i]), int(at[i + 1])
            if b - a >= k:
                yield first + i, np.unique(g[a:b - k + 1])
            elif b > a:
                yield first + i, K.grams(w[a:b], b - a)
            else:
                yield first + i, w[:0]


def vertex(h: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        return K.mix1(int(np.add.reduce(h)) ^ K.mix1(int(np.bitwise_xor.reduce(K.mix(h))) + len(h)))


def turn(key: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Order of a bucket's members; buckets of odd keys have the reverse one, so
    a group's members meet two of them rather than one.  Its own inverse."""
    return v ^ (np.uint64(0) - (key & np.uint64(1)))


def _members(batches):
    """Of rows sorted by key and o: each but the first of a key, with the first."""
    last = np.zeros(0, np.int64), np.zeros(0, np.int64)   # the first row of the key that is open, and the last row
    for b in batches:
        key, o = (np.concatenate((x, b.column(i).to_numpy(zero_copy_only=False))) for i, x in enumerate(last))
        if not len(key):
            continue
        start = np.concatenate(([True], key[1:] != key[:-1]))
        head = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))
        new = ~start & (o != np.concatenate((o[:1], o[:-1])))
        new[:len(last[0])] = False
        at = np.flatnonzero(new)
        u = key[at].view(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[at]), pa.array(K.signed(turn(u, o[head[at]].view(np.uint64)))),
             pa.array(K.signed(turn(u, o[at].view(np.uint64))))], ["key", "rep", "v"])
        keep = [head[-1], len(key) - 1] if head[-1] < len(key) - 1 else [head[-1]]
        last = key[keep], o[keep]


def members(records: DataFrame) -> DataFrame:
    """(key, rep, v) of records (key, o = turn(key, v)): the members of buckets but
    for each one's first, rep."""
    return stored(records.repartition("key").sortWithinPartitions("key", "o").transform(mapped, _members, "key long, rep long, v long"))


def _hashes(k: int, bits):
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(in_bitmap(bits.value, b.column("bit").to_numpy())))
            rows, v, hs = [], [], []
            for row, h in shingle_sets(b.column("text"), k):
                if len(h):
                    rows.append(row)
                    v.append(vertex(h))
                    hs.append(h.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(K.signed(np.array(v, np.uint64))),
                 pa.array(hs, pa.binary())], ["doc_id", "v", "h"])
    return run


def sets(docs: DataFrame, known: DataFrame, vertices: DataFrame, k: int) -> DataFrame:
    """(v, h): the shingle hashes of the vertices (v), read from a document of each."""
    wanted = stored(known.join(vertices, "v", "left_semi").select("v", "doc_id"))
    bits = bitmap(wanted, bits_of(F.col("doc_id")))
    read = docs.select("doc_id", "text", bits_of(F.col("doc_id")).alias("bit"))
    return (read.transform(mapped, _hashes(k, bits), "doc_id long, v long, h binary")
                .join(wanted, ["doc_id", "v"], "left_semi").dropDuplicates(["v"]).select("v", "h"))


def _similar(percent: int):
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("h"), b.column("h_b")):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, bound: Callable, k: int, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b) of vertices, the linked ones.  bound: of rows with the columns
    of known of a, and those of b with the suffix _b, those that can be."""
    meta = known.drop("doc_id")
    near = stored(pairs.join(meta.withColumnRenamed("v", "a"), "a").join(meta.toDF(*["b" if c == "v" else f"{c}_b" for c in meta.columns]), "b")
                  .transform(bound).select("a", "b"))
    found = sets(docs, known, near.select(F.explode(F.array("a", "b")).alias("v")).distinct(), k)
    full = near.join(found.toDF("b", "h_b"), "b").join(found.withColumnRenamed("v", "a"), "a")
    return stored(full.transform(mapped, _similar(percent), "a long, b long"))


def _counts(batches):
    total = np.zeros(1 << SLOTS, np.int64)
    for b in batches:
        for h in b.column("h"):
            total += np.bincount((np.frombuffer(h.as_buffer(), np.uint64) >> np.uint64(64 - SLOTS)).astype(np.int64), minlength=1 << SLOTS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])


def _rarest(counts, percent: int):
    """The shingles (with their place in its order) by which a set looks for others of its
    size or smaller, and whether others look for it by them."""
    def run(batches):
        for b in batches:
            out = []
            for v, h in zip(b.column("v").to_pylist(), b.column("h")):
                h = np.frombuffer(h.as_buffer(), np.uint64)
                n = len(h)
                order = h[np.lexsort((h, counts.value[(h >> np.uint64(64 - SLOTS)).astype(np.int64)]))]
                look, found = n - -(-percent * n // 100) + 1, n - -(-2 * percent * n // (100 + percent)) + 1
                out.append((order[:look], np.full(look, v), np.full(look, n), np.arange(look), np.arange(look) < found))
            t, v, n, at, found = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, np.zeros(0, bool))
            yield pa.RecordBatch.from_arrays([pa.array(K.signed(t)), *(pa.array(x.astype(np.int64)) for x in (v, n, at)), pa.array(found)], ["t", "v", "n", "at", "found"])
    return run


def rarest(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(t, v, n, at, found) of sets (v, h): see ``_rarest``."""
    found = stored(found)
    counted = found.transform(mapped, _counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << SLOTS, np.int64)
    for r in counted:                                     # at most 2**SLOTS rows
        counts[r["slot"]] = r["n"]
    shared = found.sparkSession.sparkContext.broadcast(counts)
    return stored(found.transform(mapped, _rarest(shared, percent), "t long, v long, n long, at long, found boolean"))


def _can(percent: int):
    """Rows of x and y, of different components, whose first shared shingle this can be."""
    return F.expr(f"""root_x <> root_y and 100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y)
                      and {100 + percent} * least(n_x - at_x, n_y - at_y) >= {percent} * (n_x + n_y)""")


def _sides(rows: DataFrame, root: DataFrame):
    rows = rows.join(root, "v", "left").withColumn("root", F.coalesce("root", "v"))
    return (rows.select("t", *[F.col(c).alias(f"{c}_{s}") for c in ("v", "n", "at", "found", "root")]) for s in "xy")


def rare_first(rows: DataFrame, root: DataFrame, percent: int = PERCENT) -> DataFrame:
    """HEADS pairs (a, b) for each set at most: with those that have a shared shingle
    earliest, ties in HEADS different orders."""
    x, y = _sides(rows, root)
    head = F.struct("v_y", "n_y", "at_y", "root_y")
    heads = (y.groupBy("t").agg(F.array(*[F.min_by(head, F.struct("at_y", F.xxhash64("v_y", F.lit(i)))) for i in range(HEADS)]).alias("heads"))
              .select("t", F.posexplode("heads").alias("i", "y")).select("t", "i", "y.*"))
    met = x.join(heads, "t").filter(_can(percent)).groupBy("v_x", "i").agg(F.min_by("v_y", F.struct("at_y", "v_y")).alias("v_y"))
    return met.select(*_pair("v_x", "v_y")).distinct()


def rare_pairs(rows: DataFrame, root: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs (a, b) of sets of different components that can link."""
    x, y = _sides(rows, root)
    larger = F.expr("n_x > n_y or n_x = n_y and v_x > v_y")
    return x.join(y.filter("found_y"), "t").filter(larger & _can(percent)).select(*_pair("v_x", "v_y")).distinct()


def _pair(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def connect(docs: DataFrame, known: DataFrame, member: DataFrame, bound: Callable, k: int, percent: int = PERCENT) -> DataFrame:
    """(v, root) of the vertices that links connect to a smaller one.  docs (doc_id,
    text); known (v, doc_id, and what bound needs); member as of ``members``."""
    shared = member.groupBy("v", "rep").agg(F.count("*").alias("n"))
    best = shared.groupBy("v").agg(F.max_by("rep", F.struct("n", "rep")).alias("rep"))
    first = stored(best.select(*_pair("v", "rep")).distinct())
    linked = verified(first, docs, known, bound, k, percent)
    root = components(linked)
    # buckets that hold several components
    of = lambda name: root.select(F.col("v").alias(name), F.col("root").alias(f"root_{name}"))
    apart = member.join(of("rep"), "rep", "left").join(of("v"), "v", "left").filter(F.coalesce("root_rep", "rep") != F.coalesce("root_v", "v"))
    held = stored(apart.select("key").distinct())
    if held.isEmpty():
        return root
    inside = member.join(held, "key", "left_semi")
    rows = stored(inside.select("key", "v").unionByName(inside.select("key", F.col("rep").alias("v")).distinct()))
    few = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") <= FEW).select("key")
    small = (rows.join(few, "key", "left_semi").join(root, "v", "left").groupBy("key")
                 .agg(F.sort_array(F.collect_list(F.struct("v", F.coalesce("root", "v").alias("r")))).alias("m"))
                 .select(F.explode(F.flatten(F.transform("m", lambda x: F.transform(F.filter("m", lambda y: (y["v"] > x["v"]) & (y["r"] != x["r"])),
                                                                                   lambda y: F.struct(x["v"].alias("a"), y["v"].alias("b")))))).alias("p"))
                 .select("p.*"))
    tested, pairs = first, small
    many = stored(rows.join(few, "key", "left_anti").select("v").distinct())
    rare = None if many.isEmpty() else rarest(sets(docs, known, many, k), percent)
    for last in ((False, True) if rare else (True,)):
        if rare:
            pairs = rare_pairs(rare, root, percent) if last else small.unionByName(rare_first(rare, root, percent))
        pairs = stored(pairs.distinct().join(tested, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            root = components(root.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(verified(pairs, docs, known, bound, k, percent)))
            tested = tested.unionByName(pairs)
    return root


def vertices(rows: DataFrame, known: DataFrame, root: DataFrame) -> DataFrame:
    """(doc_id, v, n, component_id) of rows (doc_id, v, n), component_id the smallest
    doc_id of the row's component; rows without shingles (n = 0) are their own."""
    named = known.select("v", "doc_id").join(root, "v", "left").withColumn("root", F.coalesce("root", "v"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = named.join(least, "root").select("v", "component_id")
    return (rows.join(of, "v", "left")
                .select("doc_id", "v", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
