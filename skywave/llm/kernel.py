"""Vectorised byte kernels that run inside Arrow tasks.

A batch of texts is looked at as one byte buffer with document bounds, in
slices of about ``SLICE`` bytes (a longer document is a slice of its own), so
a task's working memory does not depend on the Arrow batch size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20240229))
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}

RAW = _VALUE
#: Words of more bytes are named by a digest.
LONG = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first 0 to 8 bytes.
_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)

#: every byte but space and \x09-\x0D
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: 0-9, letters of either case and every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def mix1(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    if len(_powers.get("p", ())) < n:
        size = max(n, SLICE + 4096)
        p = np.full(size, _BASE, np.uint64)
        q = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        p[0] = q[0] = 1
        _powers["p"], _powers["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _powers["p"], _powers["q"]


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of slices of a text column; null is
    an empty text.  bounds has one more entry than the slice has rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, "right")) - 1)
        yield first, end, raw[at[first]:at[end]], at[first:end + 1] - at[first]
        first = end


def prefix(buf: np.ndarray, values: np.ndarray = RAW) -> np.ndarray:
    """Prefix sums for :func:`spans`: entry i covers the bytes before i."""
    out = np.zeros(len(buf) + 1, np.uint64)
    if len(buf):
        np.cumsum(values[buf] * _pow(len(buf))[0][:len(buf)], out=out[1:])
    return out


def spans(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end), equal for equal bytes."""
    q = _pow(len(pre))[1]
    return mix((pre[end] - pre[start]) * q[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_bounds(buf: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of member bytes; none crosses a document."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = member[buf]
    cut = bounds[:-1][bounds[:-1] < bounds[1:]]          # starts of documents with bytes
    begin = m.copy()
    begin[1:] &= ~m[:-1]
    begin[cut] = m[cut]
    stop = m.copy()
    stop[:-1] &= ~m[1:]
    last = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    stop[last] = m[last]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def words(buf: np.ndarray, bounds: np.ndarray, member: np.ndarray):
    """(hash of each word with A-Z read as a-z, first word of each document and the end,
    starts, ends)."""
    s, e = word_bounds(buf, bounds, member)
    return word_hashes(_LOWER[buf], s, e), np.searchsorted(s, bounds), s, e


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [s, e): eight bytes at a time are mixed in, so
    that words of up to eight bytes never collide; a word over LONG bytes is named by
    a cryptographic digest."""
    size = e - s
    eight = np.ndarray((len(buf) + 1,), "<u8", np.concatenate((buf, np.zeros(8, np.uint8))).tobytes(), strides=(1,))
    h = mix(size.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    todo, at = np.flatnonzero(size <= LONG), 0
    while len(todo):
        left = np.minimum(size[todo] - at, 8)
        h[todo] = mix((h[todo] ^ (eight[s[todo] + at] & _BYTES[left])) * _U(0x9E3779B97F4A7C15) + _U(at))
        at += 8
        todo = todo[size[todo] > at]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(buf[s[i]:e[i]], digest_size=8).digest(), "little")
    return h


def grams(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes."""
    if len(w) < k:
        return np.zeros(0, np.uint64)
    n = len(w) - k + 1
    out = w[:n] * _GRAM[0]
    for j in range(1, k):
        out = out + w[j:j + n] * _GRAM[j]
    return mix(out + _U(k))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive entries (len(x) - w + 1 of them)."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
