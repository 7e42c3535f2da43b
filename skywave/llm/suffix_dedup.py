"""Substring dedup with a sparse, range-partitioned suffix array.

A byte goes if a LENGTH-byte string covers it that also starts earlier: in a
document with a smaller doc_id, or before in the same one.

*Suffixes.*  Not every suffix has to be sorted.  In each window of LENGTH bytes
the GRAM-byte string with the least hash is chosen (the leftmost of equals);
equal windows choose alike, so it is enough to look at the suffixes that start
at chosen grams, about one in 35.  A suffix is written as its leading token
(its first bytes, followed by a hash of the gram), a hash of its context (all
bytes that a window with this gram can cover), and its place.

*Buckets.*  Splitters are quantiles of the leading tokens of a bounded sample
of documents; they range-partition the suffixes.  A token that is heavier than a
bucket is split further by place.  Each bucket sorts by leading token first, and
only ties by the tokens that follow (context, place), as a multikey quicksort
does; a streaming pass compares neighbours.  A suffix whose whole context
occurs before goes with its context.  The first suffix of each context is
compared further if its leading token has other contexts: these few get their
bytes, are dealt by leading token, and are compared at each of the window
positions.  Tokens that straddle a bucket boundary are those of the splitters;
they take part in a comparison of their own that crosses the boundaries.

Compared strings are equal by 64-bit hashes of their contexts or windows.

Cases: null is the empty text; texts shorter than LENGTH lose nothing; rows that
repeat a doc_id and its text are judged as one document, and all get its
result; rows that repeat a doc_id with other texts are ordered by a hash of the
text; a null doc_id sorts first; extra columns don't matter; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.llm import kernel as K
from skywave.llm.common import BITMAP_LOG2, bitmap, in_bitmap, mapped, stored

LENGTH = 100
GRAM = 32
LEFT = LENGTH - GRAM                                     # bytes before a gram that a window with it can cover
SPAN = LEFT + LENGTH
#: Documents whose leading tokens give the splitters.
SAMPLE = 2000
#: A token with more contexts than this is compared by several tasks, each at some of the window positions.
HEAVY = 50_000
_PLACE = np.uint64((1 << 28) - 1)


def _chosen(buf: np.ndarray, bounds: np.ndarray):
    """Places of the chosen grams, their document in the slice, and prefix sums."""
    pre = K.prefix(buf)
    if len(buf) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pre
    i = np.arange(len(buf) - GRAM + 1)
    order = (K.spans(pre, i, i + GRAM) & ~_PLACE) | i.astype(np.uint64)
    least = K.sliding_min(order, LEFT + 1)
    doc = np.searchsorted(bounds, np.arange(len(least)), "right") - 1
    inside = np.arange(len(least)) + LENGTH <= bounds[doc + 1]
    low = least[inside]
    low = low[np.concatenate(([True], low[1:] != low[:-1]))] if len(low) else low
    at = np.unique((low & _PLACE).astype(np.int64))
    return at, np.searchsorted(bounds, at, "right") - 1, pre


def _suffixes(buf, bounds):
    """(leading token, context, document, place in it, bytes of context before) of chosen suffixes."""
    at, doc, pre = _chosen(buf, bounds)
    gram = K.spans(pre, at, at + GRAM)
    lead = gram >> np.uint64(24)
    for j in range(3):
        lead |= buf[at + j].astype(np.uint64) << np.uint64(56 - 8 * j)
    low, high = np.maximum(at - LEFT, bounds[doc]), np.minimum(at + LENGTH, bounds[doc + 1])
    context = K.mix(K.spans(pre, low, high) + (at - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return lead, context, doc, at, low, high


def _order(lead: np.ndarray) -> np.ndarray:
    """Unsigned order as Spark's signed order."""
    return (lead ^ np.uint64(1 << 63)).view(np.int64)


def _identity(b: pa.RecordBatch):
    return b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)


def _records(splitters: np.ndarray, shares: np.ndarray):
    """splitters: ascending tokens; shares: buckets that a token has which is a splitter more than once."""
    def run(batches):
        for b in batches:
            ids, crc = _identity(b)
            for first, _, buf, bounds in K.texts(b.column(2)):
                lead, context, doc, at, low, high = _suffixes(buf, bounds)
                if not len(at):
                    continue
                lead, row = _order(lead), first + doc
                left = np.searchsorted(splitters, lead, "left")
                edge = left < np.searchsorted(splitters, lead, "right")
                share = shares[np.minimum(left, len(shares) - 1)] if len(shares) else np.ones(len(lead), np.int64)
                spread = (K.mix(ids[row].view(np.uint64)) >> np.uint64(1)).astype(np.int64)    # by document: copies have one crc
                bucket = left + np.where(edge & (share > 1), spread % np.maximum(share, 1), 0)
                place = (crc[row] << np.uint64(32)) | (at - bounds[doc]).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.astype(np.int32)), pa.array(lead), pa.array(K.signed(context)), pa.array(ids[row]),
                     pa.array(K.signed(place)), pa.array(((at - low) << 8 | (high - at)).astype(np.int32)), pa.array(edge)],
                    ["bucket", "lead", "context", "doc", "place", "around", "edge"])
    return run


_RECORD = "bucket int, lead long, context long, doc long, place long, around int, edge boolean"


class _Neighbours:
    """Of rows sorted by lead, context, doc and place, given batch by batch: those
    whose whole context occurs before (repeat), and the first row of each context
    whose token has several.  Holds two rows."""

    def __init__(self):
        self.last = None                                 # lead, context, doc and place of the last row
        self.held = None                                 # the first row of the open token while it has one context

    def feed(self, cols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        n = len(cols[0])
        prev = [np.concatenate((c[:1] if self.last is None else [self.last[j]], c[:-1])) for j, c in enumerate(cols[:4])]
        same_lead = cols[0] == prev[0]
        same = same_lead & (cols[1] == prev[1])
        twin = same & (cols[2] == prev[2]) & (cols[3] == prev[3])
        if self.last is None:
            same_lead[0] = same[0] = twin[0] = False
        repeat, later = same & ~twin, ~same & same_lead
        opens = np.flatnonzero(~same_lead)
        shown = np.zeros(n, bool)
        if len(opens):
            several = np.add.reduceat(later.astype(np.int64), opens) > 0
            shown[opens[several]] = True
        give = repeat | later | shown
        out, mark = [c[give] for c in cols], repeat[give]
        if self.held is not None and later[:opens[0] if len(opens) else n].any():
            out = [np.concatenate(([h], c)) for h, c in zip(self.held, out)]
            mark = np.concatenate(([False], mark))
            self.held = None
        if len(opens):
            self.held = None if several[-1] else [c[opens[-1]] for c in cols]
        self.last = [c[-1] for c in cols[:4]]
        return out, mark


_NAMES = ["lead", "context", "doc", "place", "around"]


def _local(batches):
    """Compares the tokens that lie in this bucket alone; the others pass as they are."""
    scan = _Neighbours()
    for b in batches:
        cols = [b.column(n).to_numpy(zero_copy_only=False) for n in _NAMES]
        edge = b.column("edge").to_numpy(zero_copy_only=False).astype(bool)
        parts = []
        if edge.any():
            parts.append(([c[edge] for c in cols], np.zeros(int(edge.sum()), bool), True))
        if not edge.all():
            parts.append((*scan.feed([c[~edge] for c in cols]), False))
        for out, repeat, at_edge in parts:
            yield pa.RecordBatch.from_arrays([*map(pa.array, out), pa.array(repeat), pa.array(np.full(len(repeat), at_edge))],
                                             [*_NAMES, "repeat", "edge"])


def _contexts(bits):
    """The bytes around the suffixes whose token passes the bitmap."""
    def run(batches):
        for b in batches:
            ids, crc = _identity(b)
            for first, _, buf, bounds in K.texts(b.column(2)):
                lead, _, doc, at, low, high = _suffixes(buf, bounds)
                lead = _order(lead)
                keep = in_bitmap(bits.value, _token_bit(lead))
                lead, doc, at, low, high = (x[keep] for x in (lead, doc, at, low, high))
                row = first + doc
                place = (crc[row] << np.uint64(32)) | (at - bounds[doc]).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lead), pa.array(ids[row]), pa.array(K.signed(place)), pa.array((at - low).astype(np.int32)),
                     pa.array([buf[i:j].tobytes() for i, j in zip(low, high)], pa.binary())],
                    ["lead", "doc", "place", "before", "bytes"])
    return run


def _token_bit(lead: np.ndarray) -> np.ndarray:
    return (K.mix(lead.view(np.uint64)) & np.uint64((1 << BITMAP_LOG2) - 1)).astype(np.int64)


def _token_bits(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_token_bit(b.column(0).to_numpy(zero_copy_only=False)))], ["bit"])


def _compare(batches):
    """Of rows sorted by lead, salt, doc and place: the windows around a gram that occur before."""
    open_, seen = None, np.zeros(0, np.uint64)
    for b in batches:
        for start in range(0, len(b), 4096):
            part = b.slice(start, 4096)
            n = len(part)
            lead, salt, parts, before, doc, place = (part.column(c).to_numpy(zero_copy_only=False) for c in ("lead", "salt", "parts", "before", "doc", "place"))
            text = part.column("bytes").to_pylist()
            flat = np.zeros((n, SPAN), np.uint8)
            size = np.array([len(t) for t in text])
            for i, t in enumerate(text):
                flat[i, LEFT - before[i]:LEFT - before[i] + size[i]] = np.frombuffer(t, np.uint8)
            pre = K.prefix(flat.reshape(-1))
            offset = np.arange(LEFT + 1)                 # bytes of the window before the gram
            begin = (np.arange(n) * SPAN + LEFT)[:, None] - offset[None, :]
            valid = (offset[None, :] <= before[:, None]) & (LENGTH - offset[None, :] <= (size - before)[:, None])
            valid &= offset[None, :] % parts[:, None] == salt[:, None]
            i, j = np.nonzero(valid)
            s = begin[i, j]
            token = K.mix(lead.view(np.uint64) + salt.astype(np.uint64))
            key = K.mix(K.spans(pre, s, s + LENGTH) + token[i] + j.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, at, group = np.unique(key, return_index=True, return_inverse=True)
            again = at[group] != np.arange(len(key))
            group_of = np.concatenate(([0], np.cumsum((lead[1:] != lead[:-1]) | (salt[1:] != salt[:-1]))))
            if open_ == (lead[0], salt[0]):
                again |= (group_of[i] == 0) & np.isin(key, seen)
            else:
                seen = seen[:0]
            last = key[group_of[i] == group_of[-1]]
            seen = np.union1d(seen, last) if group_of[-1] == 0 else np.unique(last)
            open_ = (lead[-1], salt[-1])
            if again.any():
                row, o = i[again], j[again]
                change = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                rows = row[change]
                least, most = np.minimum.reduceat(o, change), np.maximum.reduceat(o, change)
                at_ = (place[rows].view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[rows]), pa.array((place[rows].view(np.uint64) >> np.uint64(32)).astype(np.int64)),
                     pa.array(at_ - most), pa.array(at_ - least + LENGTH)], ["doc", "crc", "start", "end"])


def _splitters(docs: DataFrame, buckets: int):
    """Quantiles of the leading tokens of about SAMPLE documents, chosen by a hash."""
    share = F.pmod(F.xxhash64("crc", "doc"), F.lit(1 << 30)) < F.lit((SAMPLE << 30) // max(SAMPLE, docs.count()))
    sample = docs.filter(share).select("text")
    tokens = sample.transform(mapped, _sampled, "lead long").filter("lead is not null")
    cut = tokens.agg(F.percentile_approx("lead", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] if buckets > 1 else []
    cut, count = np.unique(np.array(cut or [], np.int64), return_counts=True)
    return np.repeat(cut, count), np.repeat(count, count)


def _sampled(batches):
    for b in batches:
        for _, _, buf, bounds in K.texts(b.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(_order(_suffixes(buf, bounds)[0]))], ["lead"])


def _intervals(rows: DataFrame) -> DataFrame:
    place = F.col("place").bitwiseAND(0xFFFFFFFF)
    return rows.select("doc", F.shiftrightunsigned("place", 32).alias("crc"),
                       (place - F.shiftright("around", 8)).cast("long").alias("start"),
                       (place + F.col("around").bitwiseAND(255)).cast("long").alias("end")).filter(f"end - start >= {LENGTH}")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc, crc, start, end): byte ranges that occur before, overlapping ones as they come.

    docs: doc (long), crc (long), text."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters, shares = _splitters(docs, buckets)
    names = _NAMES
    # a token that is no splitter lies in one bucket; the others are compared across the boundaries below
    rows = docs.select("doc", "crc", "text").transform(mapped, _records(splitters, shares), _RECORD)
    local = stored(rows.repartitionById(buckets, "bucket").sortWithinPartitions("lead", "context", "doc", "place")
                   .transform(mapped, _local, "lead long, context long, doc long, place long, around int, repeat boolean, edge boolean"))
    edge = local.filter("edge").select(*names).distinct()
    least = edge.groupBy("lead", "context").agg(F.min(F.struct("doc", "place", "around")).alias("m"))
    repeat = (edge.join(least, ["lead", "context"])
                  .filter("doc <> m.doc or place <> m.place").select(*names))
    several = least.groupBy("lead").agg(F.count("*").alias("n")).filter("n > 1").select("lead")
    firsts = (least.join(several, "lead").select("lead", F.col("m.doc").alias("doc"), F.col("m.place").alias("place"))
              .unionByName(local.filter("not edge and not repeat").select("lead", "doc", "place")))
    whole = _intervals(local.filter("not edge and repeat").select(*names).unionByName(repeat))
    firsts = stored(firsts)
    bits = bitmap(firsts.select("lead").transform(mapped, _token_bits, "bit long"), F.col("bit"))
    count = firsts.groupBy("lead").agg(F.count("*").alias("n"))
    parts = F.least(F.lit(LEFT + 1), F.floor(F.col("n") / HEAVY) + 1).cast("int")
    around = (docs.select("doc", "crc", "text").transform(mapped, _contexts(bits), "lead long, doc long, place long, before int, bytes binary")
                  .dropDuplicates(["lead", "doc", "place"]))
    dealt = (firsts.join(count.select("lead", parts.alias("parts")), "lead").join(around, ["lead", "doc", "place"])
                   .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                   .repartition("lead", "salt").sortWithinPartitions("lead", "salt", "doc", "place"))
    near = dealt.transform(mapped, _compare, "doc long, crc long, start long, end long")
    return whole.unionByName(near)


def _cut(text: bytes, ranges) -> tuple[bytes, int, list[tuple[int, int]]]:
    """What is left of the text without the ranges (ascending by start), the bytes that go, and the merged ranges."""
    merged: list[list[int]] = []
    for r in ranges or ():
        if merged and r["start"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], r["end"])
        else:
            merged.append([r["start"], r["end"]])
    kept, at = [], 0
    for s, e in merged:
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return b"".join(kept), sum(e - s for s, e in merged), [(s, e) for s, e in merged]


def _results(keep_text: bool):
    def run(batches):
        for b in batches:
            ids, kept, removed, n, spans, sha = b.column("doc_id"), [], [], [], [], []
            for t, r in zip(b.column("text"), b.column("ranges")):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                left, gone, merged = _cut(raw, r.as_py())
                kept.append(left if keep_text else None)
                n.append(len(raw))
                removed.append(gone)
                spans.append(len(merged))
                sha.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def deduplicated(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: the remaining bytes)."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = named.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("doc"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc"), "text")
    ranges = (repeated(named).groupBy("doc", "crc")
              .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges")))
    return (named.join(ranges, ["doc", "crc"], "left").select("doc_id", "text", "ranges")
                 .transform(mapped, _results(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
