"""Near-duplicate removal with HyperMinHash sketches.

*Sketch.*  A set has REGISTERS registers.  A hash of each shingle names a bucket
by its first bits; of the rest the smallest value of a bucket is kept as the
number of its leading zeros and the MANTISSA bits that follow the first one: 16
bits instead of 64.  Large sets fill all registers with one hash function; of a
smaller set that would leave most empty, so it takes several functions with
fewer buckets each, eight shingles to a bucket or more (below sixteen shingles:
one bucket a function).  Sets of a size class have the same layout; a set near the
upper end of its class has a second sketch in the next class's layout, where
larger sets that can be similar to it lie.

*Bands.*  BAND registers in a row, compressed as they are, make a band's join
key.  A pair of similarity 0.8 shares one of the 42 bands but for one case in
10**13, and above that more surely.

*Estimate.*  Registers of different minima can agree.  How often is worked out
from the sizes (the chance that two minima fall into one register value), and the
share of agreeing registers is corrected by it: J = (c - e) / (1 - e).  A pair goes
on if J is above PERCENT less SIGMAS standard errors, and then its whole sets
decide (``shingles.connect``, which also says which members of a bucket are
compared).

Shingles are compared by 64-bit hashes.  Cases: null or empty texts have no
shingles, link with nothing and are their own component; repeated rows are the
same vertex; extra columns don't matter; rows with a null doc_id are a component
of the smallest doc_id linked with them, else of their own (null); an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.llm import kernel as K
from skywave.llm.common import mapped, stored
from skywave.llm.shingles import PERCENT, connect, members, shingle_sets, turn, vertex, vertices

WORDS = 4
REGISTERS, BAND, MANTISSA = 128, 3, 10
#: Shingles a bucket has at least, in classes with more than one bucket a function.
LOAD = 8
SIGMAS = 6
EMPTY = 0xFFFF
_LARGEST = REGISTERS.bit_length() - 1
_SEED = K.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def size_class(n: int) -> int:
    """log2 of the buckets that each hash function has for sets of n shingles."""
    return min(max((n // LOAD).bit_length() - 1, 0), _LARGEST)


def reaches_next(n: int) -> bool:
    """Whether sets of the next class can be similar to one of n shingles."""
    return size_class(100 * n // PERCENT) > size_class(n)


def registers(h: np.ndarray, bits: int) -> np.ndarray:
    """The sketch with 2**bits buckets a function, of REGISTERS 16-bit registers."""
    functions = REGISTERS >> bits
    g = K.mix(h[None, :] ^ _SEED[:functions, None])
    least = np.full(REGISTERS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    bucket = (np.arange(functions, dtype=np.int64) << bits)[:, None] + (g >> np.uint64(64 - bits) if bits else np.zeros_like(g)).astype(np.int64)
    np.minimum.at(least, bucket.ravel(), (g << np.uint64(bits)).ravel())
    return compressed(least)


def compressed(least: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and the MANTISSA bits after the first one of each minimum."""
    top = np.zeros(len(least), np.uint64)                  # place of the highest set bit
    x = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = (x >> np.uint64(step)) != 0
        top[more] += np.uint64(step)
        x[more] >>= np.uint64(step)
    mantissa = (least << (np.uint64(63) - top) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out = ((np.uint64(63) - top) << np.uint64(MANTISSA)) | mantissa
    out[least == np.uint64(0xFFFFFFFFFFFFFFFF)] = EMPTY
    return out.astype(np.uint16)


@lru_cache(4096)
def _cells(step: int) -> np.ndarray:
    """Chance of each register value for a bucket of 2**(step / 8) shingles."""
    load = 2.0 ** (step / 8)
    zeros = np.arange(48)[:, None]
    edge = 2.0 ** -(zeros + 1.0) * (1 + np.arange((1 << MANTISSA) + 1)[None, :] / (1 << MANTISSA))
    return -np.diff(np.exp(load * np.log1p(-np.minimum(edge, 1 - 1e-16))), axis=1)


@lru_cache(65536)
def _agree(a: int, b: int) -> float:
    return float((_cells(a) * _cells(b)).sum())


def collisions(n: int, m: int, bits: int) -> float:
    """Chance that the registers of different minima agree, for sets of n and m shingles."""
    step = lambda x: max(0, round(8 * np.log2(max(x, 1) / (1 << bits))))
    return _agree(step(min(n, m)), step(max(n, m)))


def estimate(x: np.ndarray, y: np.ndarray, n: int, m: int, bits: int) -> tuple[float, int]:
    """Similarity of two sketches, corrected for collisions, and the registers it rests on."""
    held = (x != EMPTY) | (y != EMPTY)
    count = int(held.sum())
    if not count:
        return 0.0, 0
    e = collisions(n, m, bits)
    return max(0.0, (float(((x == y) & held).sum()) / count - e) / (1 - e)), count


def _sketches(k: int):
    def run(batches):
        for b in batches:
            ids, v, n, own, above = [], [], [], [], []
            for row, h in shingle_sets(b.column("text"), k):
                bits = size_class(len(h))
                ids.append(row)
                n.append(len(h))
                v.append(vertex(h) if len(h) else 0)
                own.append(registers(h, bits).tobytes() if len(h) else None)
                above.append(registers(h, bits + 1).tobytes() if len(h) and reaches_next(len(h)) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(K.signed(np.array(v, np.uint64))), pa.array(n, pa.int64()),
                 pa.array(own, pa.binary()), pa.array(above, pa.binary())], ["doc_id", "v", "n", "own", "above"])
    return run


def band_keys(regs: np.ndarray, bits: int) -> np.ndarray:
    """Join keys of sketches (one a row) of a class."""
    bands = REGISTERS // BAND
    r = regs[:, :bands * BAND].reshape(len(regs), bands, BAND).astype(np.uint64)
    value = r[..., 0]
    for j in range(1, BAND):
        value = (value << np.uint64(16)) | r[..., j]
    return K.mix(value + K.mix(np.arange(bands, dtype=np.uint64) + np.uint64((bits + 1) << 32))[None, :])


def _records(batches):
    for b in batches:
        v, n = (b.column(c).to_numpy() for c in ("v", "n"))
        bits = np.array([size_class(int(x)) for x in n], np.int64)
        key, o = [], []
        for column, of in (("own", bits), ("above", bits + 1)):
            have = np.asarray(b.column(column).is_valid())
            for c in np.unique(of[have]):
                at = np.flatnonzero(have & (of == c))
                regs = np.frombuffer(b"".join(b.column(column).take(pa.array(at)).to_pylist()), np.uint16).reshape(len(at), REGISTERS)
                ks = band_keys(regs, int(c))
                key.append(ks.ravel())
                o.append(np.repeat(v[at].view(np.uint64), ks.shape[1]))
        if key:
            k, u = np.concatenate(key), np.concatenate(o)
            yield pa.RecordBatch.from_arrays([pa.array(K.signed(k)), pa.array(K.signed(turn(k, u)))], ["key", "o"])


def _estimated(batches):
    for b in batches:
        ok = []
        for n, m, x, up, y, yup in zip(*(b.column(c).to_pylist() for c in ("n", "n_b", "own", "above", "own_b", "above_b"))):
            p, q = size_class(n), size_class(m)
            x, y = (x if p >= q else up), (y if q >= p else yup)
            if 100 * min(n, m) < PERCENT * max(n, m) or x is None or y is None:
                ok.append(False)
                continue
            j, count = estimate(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), n, m, max(p, q))
            ok.append(j >= PERCENT / 100 - SIGMAS * np.sqrt(PERCENT * (100 - PERCENT) / max(count, 1)) / 100)
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def likely(pairs: DataFrame) -> DataFrame:
    """Of pairs with sizes and sketches, those whose estimated similarity is near PERCENT or above."""
    return pairs.select("a", "b", "n", "n_b", "own", "above", "own_b", "above_b").transform(mapped, _estimated, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): component_id is the smallest doc_id that
    links reach, the document's own included; kept if that is the document itself."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(docs.transform(mapped, _sketches(k), "doc_id long, v long, n long, own binary, above binary"))
    known = stored(rows.filter("n > 0").groupBy("v", "n").agg(F.min("doc_id").alias("doc_id"), F.first("own").alias("own"), F.first("above").alias("above")))
    member = members(known.select("v", "n", "own", "above").transform(mapped, _records, "key long, o long"))
    root = connect(docs, known, member, likely, k)
    return vertices(rows.select("doc_id", "n", "v"), known, root).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
