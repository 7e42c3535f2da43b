"""Near-duplicate links by a parity-sketch join.

Every document is its set of distinct k-word shingles.  Two documents link
when their Jaccard similarity is at least PERCENT / 100; for sets of sizes
a and b that is the case only if their symmetric difference is at most
``(100 - PERCENT) (a + b) / (100 + PERCENT)``.

*Sketch.*  Each shingle toggles (XOR) one bit of a long bit sketch, so the
Hamming distance of two sketches never exceeds the symmetric difference.
The sketch is cut into pieces whose number suits the largest set of a size
band; a pair with difference d agrees on all but d pieces at most.  A piece is
kept as the XOR of a random word per set bit, which is its parity sketch in
eight bytes.

*Pigeonhole.*  Pieces without a set bit would match everywhere, so only set
pieces count: a document emits its first d + 1 set pieces, in a common order, as
join keys.  Of two similar documents, the one whose emitted pieces end first
has an agreeing piece among them, and the other one has emitted it, too.  A
document with fewer set pieces than that (rare: the piece count has a margin)
emits all it has and one key that it shares with the others of its kind in the
band.  Sets near the lower edge of the next band emit keys there as well, so no
pair is lost between bands.

*Verify.*  Candidates pass the size bound, then the Hamming distance of the
whole (folded) sketches, then the exact comparison of the shingle sets.  Rows
of equal sets are one vertex, which holds groups of exact copies together.  The
module ``shingles`` says which members of a bucket are compared, so that a group
of near copies takes a few comparisons per member and no link is missed.

Shingles are compared by 64-bit hashes.  Cases: null or empty texts have no
shingles, link with nothing and are their own component; repeated rows are the
same vertex; extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skywave.llm import kernel as K
from skywave.llm.common import BITMAP_LOG2, bitmap, in_bitmap, mapped, stored
from skywave.llm.shingles import PERCENT, connect, members, shingle_sets, turn, vertex, vertices

WORDS = 5
#: The sizes of a band's largest and smallest set differ by about this factor.
BAND = 2.44
#: A shingle is looked at as common if a task meets it so often among CHUNK shingles,
#: and is common if it adds up to COMMON, or one in COMMON_SHARE documents.
REPEATED, CHUNK, COMMON, COMMON_SHARE = 3, 1 << 20, 8, 20_000


def bands(limit: int = 1 << 40) -> list[int]:
    """Smallest size of each band."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


EDGES = np.array(bands(), np.int64)


def pieces(band: int) -> int:
    """Pieces of a band's sketch: its largest sets have four shingles a piece or
    less, so that set pieces outnumber the largest difference."""
    top = int(EDGES[band + 1]) - 1
    return 1 if top * 2 * (100 - PERCENT) < 100 + PERCENT else int(np.ceil(top / 4 + 0.8 * np.sqrt(top)))


def sketch(h: np.ndarray) -> np.ndarray:
    """Parity sketch of as many bits as the set has shingles, or up to twice as
    many (a power of two, 64 at least); halves XORed give the shorter sketch."""
    size = max(64, 1 << int(len(h)).bit_length())
    odd = np.bincount((h >> np.uint64(7)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def close(pairs: DataFrame) -> DataFrame:
    """Of pairs with the sizes n and n_b, and the sketches, of two sets, those that can
    be similar (sketches of similar sets differ in size by a factor of two at most)."""
    def folded(bits, other):
        half = (F.size(bits) / 2).cast("int")
        return F.when(F.size(bits) > F.size(other), F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(bits)

    x, y, n, m = (F.col(c) for c in ("sketch", "sketch_b", "n", "n_b"))
    far = F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, c: s + c)
    return pairs.filter((100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * far <= (100 - PERCENT) * (n + m)))


def keys(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Join keys of a set, in its own band and in the next one if sets there
    can be similar to it.  common: which of the shingles are."""
    n, out = len(h), []
    own = int(np.searchsorted(EDGES, n, "right")) - 1
    for band in (own, own + 1):
        if band > own and 100 * n < PERCENT * int(EDGES[band]):
            break
        partner = min(100 * n // PERCENT, int(EDGES[band + 1]) - 1)
        need = (100 - PERCENT) * (n + partner) // (100 + PERCENT) + 1
        p = pieces(band)
        piece = ((h >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)       # ascending, as h is
        word = K.mix((h & np.uint64(0xFFFFFFFF)) + np.uint64((band + 1) << 40))
        start = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
        parity = np.bitwise_xor.reduceat(word, start)
        kept = np.flatnonzero(parity)
        few = len(kept) < need
        last = np.logical_and.reduceat(common, start)[kept]
        kept = np.concatenate((kept[~last], kept[last]))[:need]
        out.append(K.mix(parity[kept] ^ K.mix(piece[start][kept] + np.uint64((band + 1) << 50))))
        if few:
            out.append(np.array([K.mix1((band + 1) * 7919)], np.uint64))
    return np.concatenate(out)


def _vertices(k: int):
    """A row per document, and rows with a negative n for shingles that this task met often."""
    def run(batches):
        met, size, kind = [], 0, None
        for b in batches:
            ids, v, n, sk = [], [], [], []
            kind = b.column(0).type
            for row, h in shingle_sets(b.column(1), k):
                ids.append(row)
                n.append(len(h))
                v.append(vertex(h) if len(h) else 0)
                sk.append(sketch(h) if len(h) else None)
                met.append(h)
                size += len(h)
                if size >= CHUNK:
                    yield _often(met, kind)
                    met, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(K.signed(np.array(v, np.uint64))),
                 pa.array(n, pa.int64()), pa.array(sk, pa.list_(pa.int64()))], ["doc_id", "v", "n", "sketch"])
        if met:
            yield _often(met, kind)
    return run


def _often(sets: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate(sets), return_counts=True)
    h, n = h[n >= REPEATED], n[n >= REPEATED]
    return pa.RecordBatch.from_arrays([pa.nulls(len(h), kind), pa.array(K.signed(h)), pa.array(-n.astype(np.int64)), pa.nulls(len(h), pa.list_(pa.int64()))],
                                      ["doc_id", "v", "n", "sketch"])


def _bit(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64((1 << BITMAP_LOG2) - 1)).astype(np.int64)


def _records(k: int, common):
    def run(batches):
        seen: set[int] = set()                            # of this task's rows
        for b in batches:
            ks, vs = [], []
            for _, h in shingle_sets(b.column(0), k):
                if len(h) and (v := vertex(h)) not in seen:
                    seen.add(v)
                    ks.append(keys(h, in_bitmap(common.value, _bit(h))))
                    vs.append(np.full(len(ks[-1]), v, np.uint64))
            if ks:
                key, v = np.concatenate(ks), np.concatenate(vs)
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(key)), pa.array(K.signed(turn(key, v)))], ["key", "o"])
    return run


def groups(docs: DataFrame, k: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, vertices, roots): documents (doc_id, n, v), one row each;
    vertices (v, doc_id: the smallest of its documents); roots (v, root) of the
    vertices that links of PERCENT similarity connect to a smaller one."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(docs.transform(mapped, _vertices(k), "doc_id long, v long, n long, sketch array<long>"))
    often, rows = rows.filter("n < 0"), rows.filter("n >= 0")
    least = max(COMMON, rows.count() // COMMON_SHARE)
    common = bitmap(often.groupBy("v").agg(F.sum("n").alias("n")).filter(F.col("n") <= -least),
                    F.col("v").bitwiseAND((1 << BITMAP_LOG2) - 1))
    known = stored(rows.filter("n > 0").groupBy("v", "n").agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch")))
    member = members(docs.select("text").transform(mapped, _records(k, common), "key long, o long"))
    return rows.select("doc_id", "n", "v"), known.select("v", "doc_id"), connect(docs, known, member, close, k)


def _named(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, v, n, component_id), a row per row of docs."""
    return vertices(*groups(docs, k))


def near_duplicates(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id
    that links reach, the document's own included."""
    return _named(docs, k).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _with_vertex(k: int):
    def run(batches):
        for b in batches:
            v = np.zeros(len(b), np.uint64)
            for row, h in shingle_sets(b.column("text"), k):
                v[row] = vertex(h) if len(h) else 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(K.signed(v))], [*b.schema.names, "v"])
    return run


def deduplicated(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """docs with one row of each component: of the doc_id that names it, the one
    whose text has the least vertex and hash.  Rows with a null doc_id belong to no
    component and stay, as do rows without words."""
    found = stored(_named(docs, k))
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    repeated = stored(found.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("many_id")))
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    whole = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*columns).alias("others"), "text")
    out = [F.col("text") if c == "text" else F.col(f"others.`{c}`") for c in docs.columns]
    stays = lambda rows: rows.join(gone, F.col("id") == F.col("gone_id"), "left_anti")
    if repeated.isEmpty():
        return stays(whole).select(*out)
    # ids with several rows: each row is judged by its own text
    single = stays(whole.join(repeated, F.col("id") == F.col("many_id"), "left_anti"))
    rows = whole.join(repeated, F.col("id") == F.col("many_id"), "left_semi")
    rows = rows.transform(mapped, _with_vertex(k), StructType([*rows.schema.fields, StructField("v", LongType())]))
    of = (found.filter("n > 0").join(repeated, F.col("doc_id") == F.col("many_id"), "left_semi")
               .select(F.col("doc_id").alias("of_id"), F.col("v").alias("of_v"), "component_id").distinct())
    judged = rows.join(of, (F.col("id") == F.col("of_id")) & (F.col("v") == F.col("of_v")), "left")
    wordless = judged.filter("component_id is null")
    first = Window.partitionBy("component_id").orderBy("v", F.xxhash64("text"))
    kept = judged.filter("component_id = id").withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place")
    return single.select(*out).unionByName(kept.unionByName(wordless).select(*out))
