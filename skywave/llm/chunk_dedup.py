"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes: h = (h << 1) + G[byte], of which the lowest
WINDOW bits depend on the last WINDOW bytes only.  A chunk ends where the mask bits
are zero, not before LEAST bytes (WINDOW, for a document's first) and after MOST
at the latest, so boundaries follow the content and come back in step after an
insertion.  Chunks are equal
by their 128-bit digest; the first occurrence (smallest doc_id, then place) of
a digest stays.  Single short chunks repeat by accident or by custom, so only
runs of repeated chunks of RUN bytes or more are removed.

A document is cut in the task that reads it; its chunks leave it as (digest,
place).  The smallest place of a digest is aggregated with a map-side combine,
so a passage that a third of all documents hold arrives once per task.  A second
pass cuts again and sends on only chunks whose digest passes a bitmap (of fixed
size) of the repeated ones; these join their first place by digest, exactly.

Cases: null is the empty text and has no chunks; a text shorter than LEAST is
one chunk; rows that repeat a doc_id and its text count as one document and
get the same result; rows that repeat a doc_id with other texts are ordered by
a hash of the text; a null doc_id sorts first; extra columns don't matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.llm import kernel as K
from skywave.llm.common import BITMAP_LOG2, bitmap, in_bitmap, mapped, stored

WINDOW = 32
LEAST = 16
MOST = 1024
MASK_BITS = 4
RUN = 100

_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint64)
_MASK = np.uint64(((1 << MASK_BITS) - 1) << (WINDOW - MASK_BITS))


def gear(buf: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling the covered length."""
    h, width = _GEAR[buf], 1
    while width < WINDOW:
        more = np.zeros_like(h)
        more[width:] = h[:-width] << np.uint64(width)
        h, width = h + more, 2 * width
    return h


def cuts(marks: np.ndarray, start: int, end: int) -> list[int]:
    """Chunk ends of a document at [start, end): marks are the places after which a chunk may end."""
    out, at = [], start
    for m in marks.tolist():
        while m - at > MOST:
            at += MOST
            out.append(at)
        if m - at >= LEAST:
            out.append(m)
            at = m
    while end - at > MOST:
        at += MOST
        out.append(at)
    if at < end:
        out.append(end)
    return out


def chunks(buf: np.ndarray, bounds: np.ndarray):
    """(document, start, end) of each chunk of a slice; places count from the slice's start."""
    marks = np.flatnonzero((gear(buf) & _MASK) == 0) + 1 if len(buf) else np.zeros(0, np.int64)
    # before its first WINDOW bytes are read, a document's hash would hold the one before it
    low, high = np.searchsorted(marks, bounds[:-1] + WINDOW, "left"), np.searchsorted(marks, bounds[1:], "right")
    for d in range(len(bounds) - 1):
        start = int(bounds[d])
        for end in cuts(marks[low[d]:high[d]], start, int(bounds[d + 1])):
            yield d, start, end
            start = end


def _records(bits=None):
    """Chunks as records; with bits, those only whose digest passes the bitmap."""
    def run(batches):
        for b in batches:
            ids, crc = b.column(0), b.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
            for first, _, buf, bounds in K.texts(b.column(2)):
                raw = buf.tobytes()
                doc, start, size, digest = [], [], [], []
                for d, s, e in chunks(buf, bounds):
                    digest.append(hashlib.blake2b(raw[s:e], digest_size=16).digest())
                    doc.append(first + d)
                    start.append(s - int(bounds[d]))
                    size.append(e - s)
                row = np.array(doc, np.int64)
                place = K.signed((crc[row] << np.uint64(32)) | np.array(start, np.uint64))
                out = pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), ids.take(pa.array(row)), pa.array(place), pa.array(size, pa.int32())],
                                                 ["digest", "doc", "place", "size"])
                yield out if bits is None else out.filter(pa.array(in_bitmap(bits.value, _bit(digest))))
    return run


def _bit(digests: list[bytes]) -> np.ndarray:
    """A bit number of each digest: its last bits."""
    words = np.frombuffer(b"".join(digests), np.uint64)
    return (words[1::2] & np.uint64((1 << BITMAP_LOG2) - 1)).astype(np.int64)


def _bits(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_bit(b.column(0).to_pylist()))], ["bit"])


def repeated(docs: DataFrame) -> DataFrame:
    """(doc, crc, ranges): the removed byte ranges of documents that lose any.

    docs: doc (long), crc (long), text."""
    kind = "digest binary, doc long, place long, size int"
    rows = docs.select("doc", "crc", "text")
    first = stored(rows.transform(mapped, _records(), kind).groupBy("digest").agg(F.min(F.struct("doc", "place")).alias("m"), F.count("*").alias("n"))
                   .filter("n > 1").select("digest", "m"))
    bits = bitmap(first.select("digest").transform(mapped, _bits, "bit long"), F.col("bit"))
    again = (rows.transform(mapped, _records(bits), kind).join(first, "digest").filter("doc <> m.doc or place <> m.place")
                 .select("doc", F.shiftrightunsigned("place", 32).alias("crc"),
                         F.col("place").bitwiseAND(0xFFFFFFFF).alias("start"), F.col("size")).distinct())
    found = again.groupBy("doc", "crc").agg(F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("c"))
    return found.transform(mapped, _merged, "doc long, crc long, n_repeated long, ranges array<struct<start: bigint, end: bigint>>")


def _merged(batches):
    """Chunks that touch are one run; runs of RUN bytes or more are kept."""
    for b in batches:
        if not len(b):
            continue
        c = b.column("c")
        at = c.offsets.to_numpy() - c.offsets[0].as_py()
        start, end = (c.flatten().field(i).to_numpy() for i in (0, 1))
        new = np.concatenate(([True], start[1:] != end[:-1]))[:len(start)]
        new[at[:-1]] = True                               # no document here is without a chunk
        first = np.flatnonzero(new)
        begin, stop = start[first], end[np.concatenate((first[1:] - 1, [len(start) - 1]))]
        keep = stop - begin >= RUN
        row = np.searchsorted(at, first[keep], "right") - 1
        runs = pa.StructArray.from_arrays([pa.array(begin[keep]), pa.array(stop[keep])], ["start", "end"])
        ranges = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(b) + 1)), pa.int32()), runs)
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("crc"), pa.array(np.diff(at).astype(np.int64)), ranges], ["doc", "crc", "n_repeated", "ranges"])


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(*more, "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
                       F.crc32(F.coalesce(text, F.lit(""))).alias("crc"), text.alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, n_repeated: chunks, spans)."""
    keyed = _keyed(docs)
    found = repeated(keyed)
    rows = keyed.select("doc_id", "doc", "crc", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    spans = F.coalesce("ranges", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return (rows.join(found, ["doc", "crc"], "left")
                .select("doc_id", "n_bytes", F.aggregate(spans, F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("n_removed"),
                        F.size(spans).cast("long").alias("n_spans"), F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"), spans.alias("spans")))


def _without(batches):
    for b in batches:
        kept = []
        for t, spans in zip(b.column("text"), b.column("spans").to_pylist()):
            if not t.is_valid or not spans:
                kept.append(t.as_py())
                continue
            raw, at, parts = t.as_buffer().to_pybytes(), 0, []
            for s in spans:
                parts.append(raw[at:s["start"]])
                at = s["end"]
            kept.append(b"".join([*parts, raw[at:]]).decode(errors="ignore"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.string())], ["doc_id", "text"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts without their repeated runs; a character that a
    cut splits goes."""
    keyed = _keyed(docs)
    rows = keyed.join(repeated(keyed).select("doc", "crc", F.col("ranges").alias("spans")), ["doc", "crc"], "left")
    return rows.select("doc_id", "text", "spans").transform(mapped, _without, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string")
