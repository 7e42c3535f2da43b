"""SentencePiece encoding and decoding with seeded merge-dropout.

Texts are written as a SentencePiece model of merge type (BPE) reads them: a
dummy space in front, spaces as U+2581.  An agenda holds the adjacent symbol pairs
that form a piece, best score first and leftmost of equals.  When a pair comes
up, a keyed hash of (seed, doc_id, number of the unit in the text, piece, place in
the unit) decides whether this merge is skipped, with probability ``dropout``; with
0 the result is the model's own segmentation.  So the same word is segmented anew at
each place of each document, and a document always alike, whatever executor
encodes it.  Characters without a piece become byte pieces, and
so does U+2581 itself, which makes decoding lossless.

A text is cut into units before each run of spaces; no piece reaches across such
a cut (checked when the vocabulary is read), so the agenda runs per unit.  A task
remembers of a unit the agenda without skips: its result and its offers.  Where the
keyed hash skips none of these offers, which one vectorised pass over all units of a
batch decides, the result is the remembered one; all other units run the agenda
with their skips, many at once, round by round.

The vocabulary (a bounded file, never trained here) is read on the driver from a
path that is a parameter, and broadcast.

Cases: null and empty texts have no pieces and decode to the empty text; a null
doc_id has key 0; repeated rows get the same result; extra columns don't
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.llm.common import mapped
from skywave.llm.kernel import mix, mix1

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 17
#: Units that a task remembers; when it has more, it starts anew.
REMEMBERED = 300_000
#: Rows that are segmented together, the longest units of that way, units whose offers are looked at together.
ROWS, WIDE, PART = 1000, 32, 1 << 17
TABLE = 19
NONE = np.iinfo(np.int64).max
SPACE = "▁"


class Vocabulary:
    """Pieces of a model file: ids, costs of merges, byte pieces.  Symbols are
    pieces, then single characters of pieces that are none themselves, then one
    symbol for all other characters, which never merges."""

    def __init__(self, path: str = MODEL):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.byte: list[int] = [0] * 256
        self.raw: list[bytes] = []                       # bytes that a piece stands for
        self.symbol: dict[str, int] = {}
        score = {}
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.symbol[piece] = i
                score[piece] = sp.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.length = np.array([len(r) for r in self.raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in score):
            raise ValueError("a piece reaches across a space: this model can't be cut into units")
        if len(set(self.byte)) < 256:
            raise ValueError("the model has no byte pieces: decoding could lose characters")
        for c in sorted({c for p in score for c in p} - self.symbol.keys()):
            self.symbol[c] = len(self.symbol.keys() - score.keys()) + self.size
        self.other = self.size + len(self.symbol.keys() - score.keys())
        # a merge (left, right) -> (rank, piece): rank 0 is the best score
        ranks = {x: i for i, x in enumerate(sorted(set(score.values()), reverse=True))}
        merges = {(self.symbol[p[:i]], self.symbol[p[i:]]): (ranks[score[p]], self.symbol[p])
                  for p in score for i in range(1, len(p)) if p[:i] in self.symbol and p[i:] in self.symbol}
        self.merges = merges
        keys = np.array([left << 32 | right for left, right in merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.array([rank << 32 | piece for rank, piece in merges.values()], np.int64)[order]
        self.points = np.full(0x110000, self.other, np.int32)          # of a character
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.points[ord(c)] = i
        self.points[ord(" ")], self.points[ord(SPACE)] = self.symbol[SPACE], self.other
        # a table of 2**TABLE places, by a multiplied hash and linear probing
        self.table = np.full(1 << TABLE, -1, np.int32)
        todo, at = np.arange(len(self.keys)), _slot(self.keys)
        while len(todo):
            free = self.table[at] < 0
            self.table[at[free][::-1]] = todo[free][::-1]
            left = self.table[at] != todo
            todo, at = todo[left], at[left] + 1 & (1 << TABLE) - 1

    def offers(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | piece of each merge, or NONE."""
        key = left.astype(np.int64) << 32 | right
        out = np.full(len(key), NONE, np.int64)
        todo, at = np.arange(len(key)), _slot(key)
        while len(todo):
            found = self.table[at]
            hit = (found >= 0) & (self.keys[found] == key[todo])
            out[todo[hit]] = self.values[found[hit]]
            left_ = (found >= 0) & ~hit
            todo, at = todo[left_], at[left_] + 1 & (1 << TABLE) - 1
        return out

    def decode(self, ids) -> str:
        """The text of ids, without the dummy space in front."""
        ids = np.asarray(ids, np.int64)
        size = self.length[ids]
        shift = self.start[ids] - (np.cumsum(size) - size)
        return self.flat[np.repeat(shift, size) + np.arange(size.sum())].tobytes()[1:].decode()


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE)).astype(np.int64)


_UNIT = re.compile(" *[^ ]+| +")


class Encoder:
    """Encodes texts; remembers of units the agenda without skips."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        self.v, self.limit, self.seed = vocabulary, int(dropout * (1 << 32)), np.uint64(mix1(seed))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}                   # a unit's number
        self.plain: list[bytes] = []                      # its ids without skips
        self.size = self.start = np.zeros(0, np.int64)    # its offers
        self.offered = np.zeros(0, np.uint64)

    def encode(self, text: str, key: int = 0) -> list[int]:
        return np.frombuffer(self.batch([(text, key)])[0], np.int32).tolist()

    def batch(self, texts: list[tuple[str, int]]) -> list[bytes]:
        """Ids (int32) of (text, key of the document) pairs."""
        if len(self.known) >= REMEMBERED:
            self._forget()
        cut = [_UNIT.findall(" " + text) if text else [] for text, _ in texts]
        units = [u for c in cut for u in c]
        n = np.array([len(c) for c in cut], np.int64)
        end = np.cumsum(n)
        keys = self.keys(np.repeat(np.array([key & 0xFFFFFFFFFFFFFFFF for _, key in texts], np.uint64), n),
                         np.arange(len(units)) - np.repeat(end - n, n))
        self._learn(sorted((u for u in set(units).difference(self.known) if len(u) <= WIDE), key=len))
        at = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        out = [self.plain[i] if i >= 0 else b"" for i in at.tolist()]
        if self.limit:
            todo = np.flatnonzero(self._any_skip(at, keys))
            todo = todo[np.argsort([len(units[i]) for i in todo.tolist()], kind="stable")]
            for i in range(0, len(todo), 8192):           # of like lengths
                part = todo[i:i + 8192]
                for j, packed in zip(part.tolist(), self.together([units[j] for j in part.tolist()], keys[part])):
                    out[j] = packed
        for j in np.flatnonzero(at < 0).tolist():
            out[j] = self.agenda(units[j], keys[j])
        return [b"".join(out[j - i:j]) for i, j in zip(n.tolist(), end.tolist())]

    def keys(self, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The key of each unit: of its document and its number in the text."""
        return mix((mix(doc ^ self.seed) + place.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))

    def _learn(self, units: list[str]) -> None:
        for i in range(0, len(units), 8192):              # of like lengths
            part, steps = units[i:i + 8192], []
            self.known.update(zip(part, range(len(self.plain), len(self.plain) + len(part))))
            self.plain.extend(self.together(part, None, steps))
            row = np.concatenate([r for r, _ in steps] or [np.zeros(0, np.int64)])
            offers = np.concatenate([o for _, o in steps] or [np.zeros(0, np.uint64)])
            size = np.bincount(row, minlength=len(part))
            self.start = np.concatenate((self.start, len(self.offered) + np.cumsum(size) - size))
            self.size = np.concatenate((self.size, size))
            self.offered = np.concatenate((self.offered, offers[np.argsort(row, kind="stable")]))

    def _any_skip(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether any offer of the agenda without skips is skipped: until the first
        skip both agendas take the same steps."""
        out = np.zeros(len(at), bool)
        for x in range(0, len(at), PART):
            a = at[x:x + PART]
            size = np.where(a >= 0, self.size[a], 0) if len(self.size) else np.zeros(len(a), np.int64)
            row = np.repeat(np.arange(len(a)), size)
            offer = np.repeat(self.start[a] - (np.cumsum(size) - size), size) + np.arange(size.sum()) if len(row) else row
            out[x + row[_skips(keys[x + row], self.offered[offer], self.limit)]] = True
        return out

    def together(self, units: list[str], keys: np.ndarray | None, steps: list | None = None) -> list[bytes]:
        """The agendas of many short units at once: each round takes the best offer
        of every unit that has one.  Without keys nothing is skipped; steps then
        takes the offers of each round."""
        v, n = self.v, len(units)
        if not n:
            return []
        size = np.array([len(u) for u in units])
        wide = int(size.max())
        inside = np.arange(wide)[None, :] < size[:, None]
        symbol = np.full((n, wide), v.other, np.int32)
        symbol[inside] = v.points[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]
        after = np.tile(np.arange(1, wide + 1), (n, 1))
        before = after - 2
        offer = np.full((n, wide), NONE, np.int64)
        row, at = np.nonzero(inside[:, 1:])
        offer[row, at] = v.offers(symbol[row, at], symbol[row, at + 1])
        alive = inside.copy()
        rows = np.arange(n)
        while len(rows):
            i = offer[rows].argmin(axis=1)
            best = offer[rows, i]
            more = best != NONE
            rows, i, best = rows[more], i[more], best[more]
            if keys is not None:
                skipped = _skips(keys[rows], _offered(best, i), self.limit)
                offer[rows[skipped], i[skipped]] = NONE
                r, i, best = rows[~skipped], i[~skipped], best[~skipped]
            else:
                r = rows
                if steps is not None:
                    steps.append((r, _offered(best, i)))
            j = after[r, i]
            symbol[r, i] = best & 0xFFFFFFFF
            alive[r, j] = False
            offer[r, j] = NONE
            k = after[r, i] = after[r, j]
            offer[r, i] = NONE
            inner = k < size[r]
            a, b, c = r[inner], i[inner], k[inner]
            before[a, c] = b
            offer[a, b] = v.offers(symbol[a, b], symbol[a, c])
            h = before[r, i]
            first = h >= 0
            a, b, c = r[first], i[first], h[first]
            offer[a, c] = v.offers(symbol[a, c], symbol[a, b])
        packed = symbol[alive].tobytes()
        ends = np.cumsum(alive.sum(axis=1) * 4).tolist()
        out = [packed[p:q] for p, q in zip([0, *ends], ends)]
        for x in np.flatnonzero((alive & (symbol >= v.size)).any(axis=1)).tolist():
            out[x] = self._bytes(units[x], zip(np.flatnonzero(alive[x]).tolist(), symbol[x][alive[x]].tolist()))
        return out

    def _bytes(self, unit: str, symbols) -> bytes:
        """Byte pieces for symbols that are no pieces; each is one character."""
        out: list[int] = []
        for at, s in symbols:
            out.extend([s] if s < self.v.size else [self.v.byte[x] for x in unit[at].encode()])
        return np.array(out, np.int32).tobytes()

    def agenda(self, unit: str, key: int) -> bytes:
        """One unit of any length, by a heap."""
        v, n = self.v, len(unit)
        symbol: list[int | None] = v.points[np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        key = np.array([key], np.uint64)
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := v.merges.get((symbol[i], symbol[j]))):
                heapq.heappush(heap, (m[0], i, m[1], symbol[i], symbol[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, piece, left, right = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue                                 # one of them has merged meanwhile
            if self.limit and _skips(key, _offered(np.array([piece]), np.array([i])), self.limit)[0]:
                continue
            symbol[i], symbol[j] = piece, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return self._bytes(unit, [(i, s) for i, s in enumerate(symbol) if s is not None])


def _offered(offer: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix((offer & 0xFFFFFFFF).astype(np.uint64) << np.uint64(24) | place.astype(np.uint64))


def _skips(key: np.ndarray, offered: np.ndarray, limit: int) -> np.ndarray:
    """The keyed decision on a merge."""
    return (mix(key ^ offered) >> np.uint64(32)) < np.uint64(limit)


#: The encoder of this Python worker, which Spark uses for one task after another.
_own: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary, *options) -> Encoder:
    key = (len(vocabulary.raw), zlib.crc32(b"".join(vocabulary.raw)), *options)
    if key not in _own:
        _own.clear()
        _own[key] = Encoder(vocabulary, *options)
    return _own[key]


def _encode(vocabulary, dropout: float, seed: int):
    def run(batches):
        encoder = _encoder(vocabulary.value, dropout, seed)
        for whole in batches:
            for b in (whole.slice(i, ROWS) for i in range(0, len(whole), ROWS)):
                texts = [t or "" for t in b.column("text").to_pylist()]
                ids = [np.frombuffer(packed, np.int32) for packed in encoder.batch(list(zip(texts, b.column("key").to_pylist())))]
                same = [encoder.v.decode(x) == text for x, text in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array(same, pa.bool_()),
                                                  pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_pieces", "lossless", "ids"])
    return run


def encoded(docs: DataFrame, path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_pieces, lossless: the ids decode to the text, ids)."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    key = F.when(F.col("doc_id").isNull(), 0).otherwise(F.xxhash64(F.col("doc_id").cast("string")))
    rows = docs.select("doc_id", key.cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.transform(mapped, _encode(shared, dropout, seed), f"doc_id {kind}, n_pieces long, lossless boolean, ids array<int>")


def _decode(vocabulary):
    def run(batches):
        v: Vocabulary = vocabulary.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.decode(ids or ()) for ids in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])
    return run


def decoded(ids: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    shared = ids.sparkSession.sparkContext.broadcast(Vocabulary(path))
    return ids.select("doc_id", "ids").transform(mapped, _decode(shared), f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, text string")
