"""Prefix trie of conversations by union-find over sorted-neighbour LCP edges.

A conversation is the sequence of its turns' digests (the first 128 bits of a
SHA-256 over role and text).  Conversations are range-partitioned and sorted by
that sequence, so those that start alike are neighbours, however many there are:
the conversation id is part of the sort key, and thousands of copies are dealt
to several partitions.

*Forest of a batch.*  Between neighbours lies an edge as deep as their longest
common prefix (LCP).  The edges are taken in descending depth; each joins two
components (union-find), which creates, or extends, the branching node at that
depth, and the turns above a component's last branching node down to that depth
are the nodes of a chain.  Every batch of at least BATCH rows is such a forest.

*Contraction.*  A node whose members are all inside its batch is final.  Only
nodes on the path of the batch's first or last row can go on in another batch:
they are contracted into two rows, those two sequences with what is final below
them added up per depth (members, smallest id, children, leaves, saved tokens).

*Merge across boundaries.*  The two rows of all batches are rows of the same
kind, sorted and merged by the same forest, round after round, until one batch
holds them; each round leaves two of at least BATCH rows.

Ids of conversations that end at a node go into its hash in ascending order.
SHA-256 can't be added up, so a node across batches streams its ids, joined to
one text per batch, through one task, which holds one such text at a time.

Cases: turns are ordered by turn (null first), equal ones by digest; null role or
text is empty; rows with a null conv_id belong to no conversation; repeated rows
are turns like any other; extra columns don't matter; an empty table has no node,
not even the root.  A conversation's digests (36 bytes a turn) must fit in a row.
``c % share`` has the sign of c.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.llm.common import mapped, stored

#: Bytes of a turn's digest.
DIGEST = 16
#: Rows of a forest at least, and boundary rows that a single forest takes.
BATCH, LAST = 1024, 1 << 16

ROW = ("seq binary, lens array<int>, conv_id long, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>")
_FOREST = ("kind int, " + ROW + ", key binary, up binary, depth long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, ends string")
_SUMS = ["n", "least", "kids", "leaves", "saved"]


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, t): t the conversation's turns in order, as (digest in hex, code points)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)
    rows = (turns.filter("conv_id is not null")
                 .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("d"), F.length(text).alias("len")))
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "d", "len"))).alias("t"))
                .select("conv_id", F.transform("t", lambda x: F.struct(x["d"].alias("d"), x["len"].alias("len"))).alias("t")))


def shared_heads(convs: DataFrame, share: int = 100, heads: int = 6) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c % share,
    then its own after its first h, h = crc32(c in decimal) % heads."""
    convs = stored(convs)
    c = F.col("conv_id")
    first = (convs.filter(c % share == 0).select(c.alias("base"), F.slice("t", 1, heads - 1).alias("head")))
    rows = convs.select("conv_id", "t", (c - c % share).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).cast("int").alias("h"))
    none = F.expr("slice(t, 1, 0)")
    return (rows.join(first, "base", "left")
                .select("conv_id", F.concat(F.coalesce(F.expr("slice(head, 1, h)"), none), F.expr("slice(t, h + 1, size(t))")).alias("t")))


def _lcp(seqs: list[bytes]) -> np.ndarray:
    """Turns that each sequence shares with the one before it (0 for the first)."""
    out = np.zeros(len(seqs), np.int64)
    size = np.fromiter((len(s) for s in seqs), np.int64, len(seqs)) // DIGEST
    flat = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, DIGEST // 8)
    at = np.cumsum(size) - size
    low = np.minimum(size[1:], size[:-1])
    rows = np.flatnonzero(low) + 1
    if len(rows):
        low = low[rows - 1]
        start = np.cumsum(low) - low
        step = np.arange(int(low.sum())) - np.repeat(start, low)
        same = (flat[np.repeat(at[rows], low) + step] == flat[np.repeat(at[rows - 1], low) + step]).all(axis=1)
        out[rows] = np.minimum.reduceat(np.where(same, np.iinfo(np.int64).max, step), start)
        out[rows] = np.minimum(out[rows], low)
    return out


def _key(seq: bytes, depth: int) -> bytes:
    return hashlib.sha256(seq[:depth * DIGEST]).digest()[:DIGEST]


def _ids(ids) -> str:
    return ",".join(map(str, ids))


class _Forest:
    """The trie of one sorted batch; see the module's notes."""

    def __init__(self, seqs, lens, convs, sums, last: bool):
        self.seqs, self.lens, self.convs, self.sums, self.last = seqs, lens, convs, sums, last
        self.depth = [len(s) // DIGEST for s in seqs]
        self.nodes: list[list] = []                       # conv, depth, parent (in nodes), n, kids, leaves, saved, ends, key, up
        self.ends: list[tuple] = []                       # (key, first id, ids) of open nodes
        self.open: dict[tuple[int, int], list] = {}       # (first or last row, depth): what is final below that node
        if sums:
            self.at = np.concatenate(([0], np.cumsum([d + 1 for d in self.depth])))[:-1]

    def build(self):
        k = len(self.seqs)
        lcp = _lcp(self.seqs)
        up = list(range(k))                               # union-find over rows; a component's root is its first row
        end = list(range(k))                              # of a root: its last row
        # of a root: depth of its top node; of the top's children that are final: nodes, number, leaves, saved tokens
        top = [[d, [], 0, 0, 0] for d in self.depth]

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for e in sorted(range(1, k), key=lambda i: -lcp[i]):
            d = int(lcp[e])
            a, b = find(e - 1), find(e)
            x, y = self._risen(top[a], a, end[a], d), self._risen(top[b], b, end[b], d)
            x[1] += y[1]
            for i in (2, 3, 4):
                x[i] += y[i]
            up[b], end[a], top[a] = a, end[b], x
        whole = self._risen(top[0], 0, k - 1, 0)
        self._close(whole, 0, k - 1)
        return self

    def _risen(self, t: list, a: int, b: int, depth: int) -> list:
        """The component's top brought to depth: its chain's nodes are closed on the way."""
        while t[0] > depth:
            t = self._close(t, a, b)
        return t

    def _close(self, t: list, a: int, b: int) -> list:
        """Closes the node t of rows a to b; returns its parent with this one child."""
        d, children, kids, leaves, saved = t
        if self.sums:
            at = self.at[a:b + 1] + d
            n, least = int(self.sums["n"][at].sum()), int(self.sums["least"][at].min())
            kids, leaves, saved = (v + int(self.sums[c][at].sum()) for v, c in ((kids, "kids"), (leaves, "leaves"), (saved, "saved")))
        else:
            n, least = b - a + 1, min(self.convs[a:b + 1])
        ends = []
        if not self.sums:
            while a + len(ends) <= b and self.depth[a + len(ends)] == d:
                ends.append(self.convs[a + len(ends)])
        if not self.last and (a == 0 or b == len(self.seqs) - 1):
            row = 0 if a == 0 else b
            self.open[row, d] = [n, least, kids, leaves, saved]
            key = _key(self.seqs[a], d) if children or ends else None
            for c in children:                            # their parent is known only later
                self.nodes[c][9] = key
            if ends:
                self.ends.append((key, ends[0], _ids(ends)))
            return [d - 1, [], 0, 0, 0]
        leaves += not kids
        saved += (n - 1) * self.lens[a][d - 1] if d else 0
        me = len(self.nodes)
        known = None if self.sums else hashlib.sha256(_ids(ends).encode()).hexdigest()
        self.nodes.append([least, d, None, n, kids, leaves, saved, known, _key(self.seqs[a], d) if self.sums else None, None])
        for c in children:
            self.nodes[c][2] = me
        return [d - 1, [me], 1, leaves, saved]

    def rows(self) -> list[tuple]:
        """Final nodes (kind 0), contracted rows (1) and ids of open ends (2)."""
        out = []
        for conv, d, parent, n, kids, leaves, saved, ends, key, up in self.nodes:
            of = None if parent is None else self.nodes[parent][0]
            out.append((0, None, None, conv, *[None] * 5, key, up, d, of, n, kids, leaves, saved, ends))
        for row in sorted({r for r, _ in self.open}):
            sums = [self.open.get((row, d), [0, np.iinfo(np.int64).max, 0, 0, 0]) for d in range(self.depth[row] + 1)]
            out.append((1, self.seqs[row], self.lens[row], self.convs[row], *(list(x) for x in zip(*sums)), *[None] * 9))
        for key, first, ids in self.ends:
            out.append((2, None, None, first, *[None] * 5, key, *[None] * 7, ids))
        return out


def _forests(last: bool):
    schema = pa.schema([("kind", pa.int32()), ("seq", pa.binary()), ("lens", pa.list_(pa.int32())), ("conv_id", pa.int64()),
                        *[(c, pa.list_(pa.int64())) for c in _SUMS], ("key", pa.binary()), ("up", pa.binary()),
                        *[(c, pa.int64()) for c in ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                        ("ends", pa.string())])

    def forest(held: list[pa.RecordBatch]):
        t = pa.Table.from_batches(held).combine_chunks()
        sums = None
        if t.column("n").null_count < len(t):
            sums = {c: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in _SUMS}
        made = _Forest(t.column("seq").to_pylist(), t.column("lens").to_pylist(), t.column("conv_id").to_pylist(), sums, last).build().rows()
        for i in range(0, len(made), 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made[i:i + (1 << 14)]), schema)], schema=schema)

    def run(batches):
        held, size = [], 0
        for b in batches:
            if len(b):
                held.append(b)
                size += len(b)
            if size >= BATCH and not last:
                yield from forest(held)
                held, size = [], 0
        if held:
            yield from forest(held)
    return run


def _hashed(batches):
    """SHA-256 of each key's texts, joined by commas, of rows sorted by key and first id."""
    key = digest = None
    for b in batches:
        keys, out = [], []
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    out.append(digest.hexdigest())
                key, digest = k, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "hash"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "hash"])


def trie(convs: DataFrame, last: int = LAST) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, t), a row each: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    last: contracted rows that the last forest may take."""
    none = F.lit(None).cast("array<long>")
    rows = stored(convs.select(
        F.unhex(F.array_join(F.transform("t", lambda x: x["d"]), "")).alias("seq"), F.transform("t", lambda x: x["len"]).alias("lens"), "conv_id",
        *[none.alias(c) for c in _SUMS]))
    found, left = [], rows
    while True:
        n = left.count() if found else None
        final = n is not None and n <= last
        dealt = left.repartition(1) if final else left.repartitionByRange("seq", "conv_id") if not found else left.repartitionByRange(max(1, n // last), "seq", "conv_id")
        made = stored(dealt.sortWithinPartitions("seq", "conv_id").transform(mapped, _forests(final), _FOREST))
        found.append(made)
        if final:
            break
        left = made.filter("kind = 1").select(*[c.split()[0] for c in ROW.split(", ")])
    nodes = found[0].filter("kind = 0")
    upper = found[1].filter("kind = 0")
    for more in found[2:]:
        upper = upper.unionByName(more.filter("kind = 0"))
    ends = (found[0].filter("kind = 2").select("key", "conv_id", F.col("ends").alias("ids")).repartition("key").sortWithinPartitions("key", "conv_id")
                    .transform(mapped, _hashed, "key binary, hash string"))
    upper = stored(upper.drop("ends").join(ends, "key", "left").withColumn("ends", F.coalesce("hash", F.sha2(F.lit(b""), 256))).drop("hash"))
    of = upper.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    def named(df: DataFrame, parent: str, *more: str) -> DataFrame:
        return df.select(*more, "conv_id", "depth", F.col(parent).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.col("ends").alias("ends_sha256"))

    whole, late = (named(nodes.filter(c), "parent_conv_id", "up").unionByName(named(upper.filter(c), "parent_conv_id", "up")) for c in ("up is null", "up is not null"))
    return whole.drop("up").unionByName(named(late.withColumnRenamed("ends_sha256", "ends").join(of, "up"), "up_conv"))
