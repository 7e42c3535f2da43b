"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

*Blocks.*  Rows are ordered along a Hilbert curve through their direction (AXES
components, two bits each), dealt to range partitions and written as Parquet,
ROWS rows to a block: ids, labels and the packed components in columns of their
own beside the zone map, the smallest and largest value of every dimension.

*Bounds.*  With components of a block in [lo, hi], interval arithmetic gives the
least and largest inner product that an anchor can have with any of its rows:
every component of the anchor takes hi or lo by its sign.  An anchor's window of
scores reads a block only if that interval meets the window, reaches the window's
k-th best score known so far, and the block has a row of a label that counts.

*Search.*  Anchors are packed into groups of up to GROUP neighbours on the curve.
Every window first reads the blocks around its anchor, whose k-th best score is a
threshold that the answer can't fall below; then it reads all blocks that the
bounds leave.  A search for the positives gives each anchor's windows for the
negatives.  Zone maps meet the anchor groups CHUNK at a time, in as many salted
parts as there are groups or SALTS; scores are matrix products of a group with a
block, and a task keeps the best k of each window.

The bounds never drop a row that counts, so the result doesn't depend on the
order, on the sizes of blocks and groups, or on how much is pruned.

Cases: rows with a null id, label or vector, or a null or non-finite component,
take no part; a shorter vector counts as if it went on with zeros; components
count as integers floor(256 x), held within 32 bits; repeated rows are rows of
their own, and so are rows that share an id (in the order of their place on the
curve); an empty table or one without anchors gives no rows; extra columns don't
matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skywave.llm.common import mapped, stored
from skywave.session import scratch_path

ROWS, GROUP, CHUNK = 64, 256, 128
#: Components that order the rows.
AXES = 32
#: Parts at most into which zone maps are dealt to meet the anchors.
SALTS = 256
#: Blocks that a part of a group's scores looks at.
PART = 32
FAR = 1 << 62


def hilbert(x: np.ndarray) -> np.ndarray:
    """Place on the Hilbert curve (as a signed 64-bit key) of each row's direction:
    each of the first AXES components in four classes, cut at the quartiles that a
    component of a random direction has."""
    n, dims = x.shape
    axes = np.zeros((AXES, n), np.uint8)
    if dims:
        size = np.sqrt(np.maximum((x.astype(float) ** 2).mean(axis=1), 1e-300))
        y = (x[:, :AXES] / size[:, None]).T
        axes[:y.shape[0]] = (y >= -0.6745).astype(np.uint8) + (y >= 0) + (y >= 0.6745)
    return (curve(axes) ^ np.uint64(1 << 63)).view(np.int64)


def curve(cells: np.ndarray) -> np.ndarray:
    """Place on the Hilbert curve of cells (axes x cells, two bits per axis: 0 to 3)."""
    axes, top = cells.copy(), 2                           # the upper bit is 2, below it 1
    for i in range(len(axes)):                               # undo the rotations of the upper bit's cells
        flip = (axes[i] & top) != 0
        change = np.where(flip, 0, (axes[0] ^ axes[i]) & 1).astype(np.uint8)
        axes[0] ^= np.where(flip, 1, change).astype(np.uint8)
        axes[i] ^= change
    axes = np.bitwise_xor.accumulate(axes, axis=0)        # Gray code over the axes
    axes ^= (axes[-1] >> 1) & 1
    key = np.zeros(axes.shape[1], np.uint64)
    for bit in (1, 0):
        for a in axes:
            key = (key << np.uint64(1)) | ((a >> bit) & 1).astype(np.uint64)
    return key


def _packed(vectors: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int32)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def _quantised(column: str):
    def run(batches):
        for b in batches:
            vec = b.column(column)
            flat, sizes = vec.flatten(), np.asarray(pc.list_value_length(vec).fill_null(0))
            x = np.floor(256 * flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
            ok = np.asarray(vec.is_valid()) & np.asarray(b.column("label").is_valid()) & np.asarray(b.column("vec_id").is_valid())
            end = np.cumsum(sizes)
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            ok &= odd[end] == odd[end - sizes]
            q = np.clip(np.nan_to_num(x), -(1 << 31), (1 << 31) - 1).astype(np.int32)
            rows = np.flatnonzero(ok)
            vectors = [q[end[i] - sizes[i]:end[i]] for i in rows]
            keep = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hilbert(_packed(vectors))), b.column("vec_id").cast(pa.int64()).take(keep), b.column("label").cast(pa.int64()).take(keep),
                 pa.array([v.tobytes() for v in vectors], pa.binary())], ["place", "vec_id", "label", "q"])
    return run


def _blocks(batches):
    at = TaskContext.get().partitionId() << 32

    def block(rows):
        nonlocal at
        x = _packed([np.frombuffer(q, np.int32) for q in rows[2]])
        labels = np.array(rows[1])
        at += 1
        return (at, x.shape[1], rows[0], rows[1], x.tobytes(), x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), np.unique(labels).tolist())

    held: list[tuple] = []
    for b in batches:
        held += zip(*(b.column(c).to_pylist() for c in ("vec_id", "label", "q")))
        whole = len(held) // ROWS * ROWS
        if whole:
            yield _batch([block(list(map(list, zip(*held[i:i + ROWS])))) for i in range(0, whole, ROWS)], _BLOCK)
            held = held[whole:]
    if held:
        yield _batch([block(list(map(list, zip(*held))))], _BLOCK)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_BLOCK = "block long, dims int, ids array<long>, labels array<long>, q binary, lo binary, hi binary, has array<long>"
_GROUP = "g long, dims int, blocks array<long>, places array<long>, ids array<long>, labels array<long>, q binary"
_FOUND = "g long, a long, no long, score long, vec_id long, block long, place long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])


def write_blocks(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The table of blocks of rows (vec_id, label, vector), as stored Parquet."""
    spark = rows.sparkSession
    path = scratch_path(spark, "hard-negative-blocks")
    placed = stored(rows.select("vec_id", "label", vector).transform(mapped, _quantised(vector), "place long, vec_id long, label long, q binary"))
    (placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id")
           .transform(mapped, _blocks, _BLOCK).write.parquet(path))
    return spark.read.parquet(path)


def _matrix(data: bytes, dims: int, width: int) -> np.ndarray:
    x = np.frombuffer(data, np.int32).reshape(-1, dims) if dims else np.zeros((0, 0), np.int32)
    return np.pad(x, ((0, 0), (0, width - dims))).astype(np.float64) if width > dims else x.astype(np.float64)


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y.T of integers: in doubles while every sum is exact there, else as 64-bit integers."""
    if x.size and y.size and np.abs(x).max() * np.abs(y).max() * x.shape[1] < 2.0 ** 53:
        return (x @ y.T).astype(np.int64)
    return x.astype(np.int64) @ y.T.astype(np.int64)


def _anchors(every: int):
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                q = np.frombuffer(r["q"], np.int32).reshape(len(r["ids"]), -1)
                out += [(r["block"], i, v, r["labels"][i], q[i].tobytes()) for i, v in enumerate(r["ids"]) if v % every == 0]
            yield _batch(out, "block long, place long, vec_id long, label long, q binary")
    return run


def _groups(batches):
    at = TaskContext.get().partitionId() << 32

    def group(rows):
        nonlocal at
        at += 1
        x = _packed([np.frombuffer(r["q"], np.int32) for r in rows])
        return (at, x.shape[1], *([r[c] for r in rows] for c in ("block", "place", "vec_id", "label")), x.tobytes())

    held: list[dict] = []
    for b in batches:
        held += b.to_pylist()
        while len(held) >= GROUP:
            yield _batch([group(held[:GROUP])], _GROUP)
            held = held[GROUP:]
    if held:
        yield _batch([group(held)], _GROUP)


def anchor_groups(blocks: DataFrame, every: int) -> DataFrame:
    """Groups of up to GROUP neighbouring anchors: rows whose id is divisible by every."""
    rows = stored(blocks.select("block", "ids", "labels", "q").transform(mapped, _anchors(every), "block long, place long, vec_id long, label long, q binary"))
    parts = max(1, rows.count() // GROUP)
    return stored(rows.repartitionByRange(parts, "block", "place").sortWithinPartitions("block", "place").transform(mapped, _groups, _GROUP))


def _around(batches):
    """For each group the blocks around its anchors, with the windows (bits) that look there."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            at = np.array(r["blocks"])[r["w_anchor"]]
            for block in np.unique(np.concatenate([at - 1, at, at + 1])):
                out.append((r["g"], int(block), np.packbits(np.abs(at - block) <= 1).tobytes()))
        yield _batch(out, "g long, block long, wins binary")


def _zones(batches):
    """Zone maps, up to CHUNK to a row."""
    for b in batches:
        rows = b.to_pylist()
        out = []
        for i in range(0, len(rows), CHUNK):
            part = rows[i:i + CHUNK]
            width = max(r["dims"] for r in part)
            lo, hi = (np.vstack([np.pad(np.frombuffer(r[c], np.int32), (0, width - r["dims"])) for r in part]) for c in ("lo", "hi"))
            out.append(([r["block"] for r in part], width, lo.astype(np.int32).tobytes(), hi.astype(np.int32).tobytes(),
                        [x for r in part for x in r["has"]], [len(r["has"]) for r in part]))
        yield _batch(out, "z_blocks array<long>, z_dims int, lo binary, hi binary, has array<long>, n_has array<long>")


def _wanted(same: bool):
    """Of rows of a group and zone maps: which blocks its windows must read."""
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                width = max(r["dims"], r["z_dims"], 1)
                x, lo, hi = _matrix(r["q"], r["dims"], width), _matrix(r["lo"], r["z_dims"], width), _matrix(r["hi"], r["z_dims"], width)
                if not x.size:
                    x = np.zeros((len(r["ids"]), width))
                if not lo.size:
                    lo = hi = np.zeros((len(r["z_blocks"]), width))
                up, down = np.maximum(x, 0), np.minimum(x, 0)
                most, least = _product(up, hi) + _product(down, lo), _product(up, lo) + _product(down, hi)
                of = np.repeat(np.arange(len(r["z_blocks"])), r["n_has"])
                has, mine = np.array(r["has"]), np.array(r["labels"])
                counts = np.zeros(most.shape, bool)
                for label in np.unique(mine):
                    blocks = np.unique(of[(has == label) if same else (has != label)])
                    counts[np.ix_(mine == label, blocks)] = True
                a, lows, highs = np.array(r["w_anchor"], np.int64), np.array(r["w_lo"])[:, None], np.array(r["w_hi"])[:, None]
                need = counts[a] & (most[a] >= lows) & (least[a] <= highs)
                for j in np.flatnonzero(need.any(axis=0)):
                    out.append((r["g"], r["z_blocks"][j], np.packbits(need[:, j]).tobytes()))
            yield _batch(out, "g long, block long, wins binary")
    return run


def _scored(same: bool, k: int):
    """Of rows of a group and a block: the best k rows of each window, of as many blocks as follow one another."""
    def best(of, state):
        score, ids, blocks, places = state
        w, j = np.nonzero(score > -FAR)
        return _batch(list(zip([of["g"]] * len(w), np.array(of["w_anchor"])[w].tolist(), np.array(of["w_no"])[w].tolist(), score[w, j].tolist(),
                               ids[w, j].tolist(), blocks[w, j].tolist(), places[w, j].tolist())), _FOUND)

    def run(batches):
        of, state = None, None
        for b in batches:
            for r in b.to_pylist():
                n = len(r["w_anchor"])
                if of is None or of["g"] != r["g"]:
                    if of is not None:
                        yield best(of, state)
                    of, state = r, [np.full((n, k), -FAR)] + [np.zeros((n, k), np.int64) for _ in range(3)]
                    a = np.array(r["w_anchor"], np.int64)
                    lows, highs = np.array(r["w_lo"])[:, None], np.array(r["w_hi"])[:, None]
                    mine = [np.array(r[c], np.int64) for c in ("labels", "blocks", "places")]
                width = max(r["dims"], r["b_dims"], 1)
                x, y = _matrix(r["q"], r["dims"], width), _matrix(r["b_q"], r["b_dims"], width)
                x, y = (z if z.size else np.zeros((m, width)) for z, m in ((x, len(r["ids"])), (y, len(r["b_ids"]))))
                score, ids, labels = _product(x, y), np.array(r["b_ids"]), np.array(r["b_labels"])
                ok = (mine[0][:, None] == labels[None]) == same
                own = np.flatnonzero(mine[1] == r["block"])
                ok[own, mine[2][own]] = False                          # never the anchor itself
                wins = np.unpackbits(np.frombuffer(r["wins"], np.uint8), count=n).astype(bool)
                new = np.where(ok[a] & wins[:, None] & (score[a] >= lows) & (score[a] <= highs), score[a], -FAR)
                better = np.flatnonzero((new.max(axis=1) >= state[0][:, -1]) & (new.max(axis=1) > -FAR))
                if not len(better):
                    continue
                m = len(better)
                place = np.arange(len(ids))
                both = [np.hstack([s[better], np.broadcast_to(v, (m, len(ids)))]) for s, v in zip(state, (new[better], ids, np.full(len(ids), r["block"]), place))]
                order = np.lexsort((both[3], both[2], both[1], -both[0]), axis=1)[:, :k]
                for s, v in zip(state, both):
                    s[better] = np.take_along_axis(v, order, axis=1)
        if of is not None:
            yield best(of, state)
    return run


def _best(pairs: DataFrame, windows: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best rows of each window (g, a, no) among the blocks of pairs, with their rank."""
    parts = max(1, blocks.count() // PART)
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part")
    read = pairs.join(blocks.select("block", F.col("dims").alias("b_dims"), F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"), F.col("q").alias("b_q")), "block")
    groups = windows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    rows = read.withColumn("part", part).join(groups, ["g", "part"])
    found = rows.transform(mapped, _scored(same, k), _FOUND)
    order = Window.partitionBy("g", "a", "no").orderBy(F.desc("score"), "vec_id", "block", "place")
    return stored(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def _search(groups: DataFrame, windows: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """The k first rows (g, a, no, rank, score, vec_id) of each window (g, a, no, lo, hi)."""
    def attached(w: DataFrame) -> DataFrame:
        lists = w.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("a", "no", "lo", "hi"))).alias("w"))
        return stored(groups.join(lists, "g").select("*", *[F.col(f"w.{c}").alias(n) for c, n in (("a", "w_anchor"), ("no", "w_no"), ("lo", "w_lo"), ("hi", "w_hi"))]).drop("w"))

    first = attached(windows)
    seeds = first.select("g", "blocks", "w_anchor").transform(mapped, _around, "g long, block long, wins binary")
    least = _best(seeds, first, blocks, same, k).filter(F.col("rank") == k).select("g", "a", "no", F.col("score").alias("tau"))
    raised = windows.join(least, ["g", "a", "no"], "left").select("g", "a", "no", F.greatest("lo", F.coalesce("tau", "lo")).alias("lo"), "hi")
    second = attached(raised)
    salts = min(SALTS, max(1, second.count()))
    zones = (blocks.select("block", "dims", "lo", "hi", "has").transform(mapped, _zones, "z_blocks array<long>, z_dims int, lo binary, hi binary, has array<long>, n_has array<long>")
                   .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))
    asked = second.withColumn("salt", F.pmod(F.xxhash64("g"), F.lit(salts)))
    pairs = zones.join(asked, "salt").transform(mapped, _wanted(same), "g long, block long, wins binary")
    return _best(stored(pairs), second, blocks, same, k)


def mined(rows: DataFrame, vector: str = "embedding", every: int = 100, positives: int = 5, negatives: int = 10,
          low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    anchor (id divisible by every) and each of its first positives rows of its label, the first
    negatives rows of other labels whose score is between low and high percent of the positive's."""
    blocks = write_blocks(rows, vector)
    groups = anchor_groups(blocks, every)
    anchors = groups.select("g", F.posexplode("ids").alias("a", "anchor_id")).select("g", F.col("a").cast("long").alias("a"), "anchor_id")
    every_score = anchors.select("g", "a", F.lit(0).cast("long").alias("no"), F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi"))
    found = _search(groups, every_score, blocks, True, positives).select("g", "a", F.col("rank").cast("long").alias("no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    p = F.col("positive_score")
    windows = found.select("g", "a", "no", ((p * low + F.pmod(-p * low, F.lit(100))) / 100).cast("long").alias("lo"), ((p * high - F.pmod(p * high, F.lit(100))) / 100).cast("long").alias("hi")).filter("lo <= hi")
    near = _search(groups, windows, blocks, False, negatives)
    return (near.select("g", "a", "no", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
                .join(found, ["g", "a", "no"]).join(anchors, ["g", "a"])
                .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by every get the next label."""
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
