"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items (A-Z as a-z, runs of digits, letters and
non-ASCII bytes) go into one suffix automaton, which is sent to the tasks.  A
benchmark of more than GROUP_WORDS words is dealt by a hash into groups of about
half as many, each with an automaton of its own, and the documents stream through one
after another: what a task or the driver holds is bounded by a group, whatever
the benchmark's size, and the hits and items of all groups are united.  Items of
more than PIECE words are cut into pieces that overlap by a window less one
word, so that every window lies in a piece.  A document's words stream through; the automaton keeps the longest suffix read so far that
occurs in some item.  Where that length reaches the window (WINDOW words, or a
whole item that is shorter), the words of the window are hit, and the state's
suffix links name the items.  ``cleaned`` cuts the hit spans out and drops
documents whose hit share exceeds a coverage limit.

Only runs of word pairs that some item has can lead anywhere, so a vectorised
pass over word-pair hashes finds these runs first, and the automaton reads them
alone; elsewhere it would stay at lengths below two.  Words are compared by
64-bit hashes.

Cases: null and empty texts have no words and no hits; items without words are
no windows; repeated rows each get their result, items of one item_id count as
one; extra columns don't matter; an empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from skywave.llm import kernel as K
from skywave.llm.common import mapped, stored

WINDOW = 10
#: Words that one automaton is built of at most, but for the hash's spread.
GROUP_WORDS = 1 << 19
#: Words of an item that stay together.
PIECE = 1 << 14
PAIR_BITS = 23


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window, self.names = window, [name for name, _ in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        short: dict[int, set[int]] = {}
        ends: list[tuple[int, int]] = []
        for i, (_, words) in enumerate(items):
            state = 0
            for w in words.tolist():
                state = self._extend(state, w)
                ends.append((state, i))
            if 0 < len(words) < window:
                short.setdefault(state, set()).add(i)
        # the items in which a state's strings occur: up the suffix links
        self.items: list[set[int]] = [set() for _ in self.link]
        for state, i in ends:
            while state > 0 and i not in self.items[state]:
                self.items[state].add(i)
                state = self.link[state]
        self.short = {s: sorted(v) for s, v in short.items()}
        self.up = [-1] * len(self.link)                  # nearest state with a short item, itself included
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.up[s] = s if s in self.short else (self.up[self.link[s]] if s else -1)
        lengths = [len(w) for _, w in items if len(w)]
        self.least = min([window, *(n for n in lengths if n > 1)])
        self.single = np.unique(np.concatenate([w for _, w in items if len(w) == 1] or [np.zeros(0, np.uint64)]))
        bits = np.zeros(1 << (PAIR_BITS - 3), np.uint8)
        for _, words in items:
            at = _pair_bit(K.grams(words, 2))
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        self.pairs = bits

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def read(self, words: list[int], hit: np.ndarray, items: set[int]) -> None:
        """Streams words; sets hit where windows lie, adds the items."""
        state, size, nexts, link, length, window = 0, 0, self.next, self.link, self.length, self.window
        for at, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                size = length[state]
            if w in nexts[state]:
                state, size = nexts[state][w], size + 1
            else:
                state = size = 0
                continue
            if size >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                hit[at - window + 1:at + 1] = True
                items |= self.items[s]
            s = self.up[state if size == length[state] else link[state]] if self.short else -1
            while s > 0:
                hit[at - length[s] + 1:at + 1] = True
                items.update(self.short[s])
                s = self.up[link[s]]


def _pair_bit(pairs: np.ndarray) -> np.ndarray:
    return (pairs & np.uint64((1 << PAIR_BITS) - 1)).astype(np.int64)


def _cut(window: int):
    size = max(PIECE, 2 * window)

    def run(batches):
        for b in batches:
            names, words = [], []
            for first, _, buf, bounds in K.texts(b.column(1)):
                w, at, _, _ = K.words(buf, bounds, K.ALNUM)
                for d in range(len(bounds) - 1):
                    own = K.signed(w[at[d]:at[d + 1]])
                    for x in range(0, max(len(own) - window + 1, 1) if len(own) else 0, size - window + 1):
                        names.append(b.column(0)[first + d].as_py())
                        words.append(own[x:x + size])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.int64()))], ["item_id", "words"])
    return run


def groups(benchmark: DataFrame, window: int = WINDOW) -> list[DataFrame]:
    """(item_id, words: hashes of a piece's words) of each group of items."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.transform(mapped, _cut(window), "item_id string, words array<long>").dropDuplicates(["item_id", "words"])
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    if total <= GROUP_WORDS:
        return [pieces]
    n = -(-2 * total // GROUP_WORDS)
    pieces = stored(pieces.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(n))))
    return [pieces.filter(F.col("part") == i).select("item_id", "words") for i in range(n)]


def automaton(group: DataFrame, window: int = WINDOW) -> Automaton:
    rows = sorted(((r[0], r[1]) for r in group.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1]))
    return Automaton([(name, np.array(words, np.int64).view(np.uint64)) for name, words in rows], window)


def _runs(good: np.ndarray, least: int) -> list[tuple[int, int]]:
    """[start, end) of runs of at least so many True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], good.astype(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return list(zip(start[long].tolist(), end[long].tolist()))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(automaton, last: bool, keep_text: bool):
    """Reads (any column, text[, hits, items: of the groups before]); gives the same
    columns with this group's hits, as runs of words, or after the last group the result."""
    def run(batches):
        a: Automaton = automaton.value
        for b in batches:
            n_words, n_hit, hits, items, spans, kept = [], [], [], [], [], []
            hits_before, items_before = (b.column(i).to_pylist() if b.num_columns > 2 else [()] * len(b) for i in (2, 3))
            for first, _, buf, bounds in K.texts(b.column(1)):
                w, at, s, e = K.words(buf, bounds, K.ALNUM)
                hit = np.zeros(len(w), bool)
                found: dict[int, set[int]] = {}
                pair = np.zeros(len(w), bool)            # words i and i + 1 are a pair of some item
                if len(w) > 1:
                    bit = _pair_bit(K.grams(w, 2))
                    pair[:-1] = (a.pairs[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                    pair[at[1:-1][at[1:-1] > 0] - 1] = False                 # not across documents
                for x, y in _runs(pair, a.least - 1):
                    a.read(w[x:y + 1].tolist(), hit[x:y + 1], found.setdefault(int(np.searchsorted(at, x, "right")) - 1, set()))
                if len(a.single):
                    for x in np.flatnonzero(np.isin(w, a.single)).tolist():
                        a.read([int(w[x])], hit[x:x + 1], found.setdefault(int(np.searchsorted(at, x, "right")) - 1, set()))
                for d in range(len(bounds) - 1):
                    x, y = int(at[d]), int(at[d + 1])
                    for r in hits_before[first + d]:
                        hit[x + r["start"]:x + r["end"]] = True
                    items.append(sorted({a.names[i] for i in found.get(d, ())} - {None} | set(items_before[first + d])))
                    runs = _runs(hit[x:y], 1)
                    if not last:
                        hits.append([{"start": i, "end": j} for i, j in runs])
                        continue
                    n_words.append(y - x)
                    n_hit.append(sum(j - i for i, j in runs))
                    cut = [(int(s[x + i]), int(e[x + j - 1])) for i, j in runs]
                    spans.append([{"start": i - int(bounds[d]), "end": j - int(bounds[d])} for i, j in cut])
                    if keep_text:
                        rest, end = [], int(bounds[d])
                        for i, j in cut:
                            rest.append(buf[end:i].tobytes())
                            end = j
                        rest.append(buf[end:bounds[d + 1]].tobytes())
                        kept.append(b"".join(rest).decode() if b.column(1)[first + d].is_valid else None)
            names = pa.array(items, pa.list_(pa.string()))
            if last:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), names, pa.array(spans, RUNS),
                     pa.array(kept if keep_text else [None] * len(n_words), pa.string())],
                    [b.schema.names[0], "n_words", "n_hit", "items", "spans", "kept"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hits, RUNS), names], [*b.schema.names[:2], "hits", "items"])
    return run


def _found(rows: DataFrame, benchmark: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """rows: any column and text; (that column, n_words, n_hit, items, spans, kept)."""
    context = rows.sparkSession.sparkContext
    own = rows.schema.fields[0]
    runs = ArrayType(StructType().add("start", LongType()).add("end", LongType()))
    state = StructType([own]).add("text", StringType()).add("hits", runs).add("items", ArrayType(StringType()))
    result = StructType([own]).add("n_words", LongType()).add("n_hit", LongType()).add("items", ArrayType(StringType())).add("spans", runs).add("kept", StringType())
    *before, last = groups(benchmark, window)
    for group in before:                                  # written after each, so that a worker holds one automaton at a time
        shared = context.broadcast(automaton(group, window))
        rows = stored(rows.transform(mapped, _scan(shared, False, False), state))
        shared.unpersist()
    shared = context.broadcast(automaton(last, window))
    return rows.transform(mapped, _scan(shared, True, keep_text), result)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans in bytes, kept: the text without the spans)."""
    return _found(docs.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, window, keep_text)


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """docs with the hit spans cut out of text (and n_chars, if there, counted
    anew), without the documents of which more than max_coverage is hit."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    found = _found(docs.select(F.struct(*others).alias("others"), F.col("text").cast("string").alias("text")), benchmark, window, True)
    left = found.filter(F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words"))
    value = {c: F.col(f"others.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("kept")}
    if "n_chars" in value:
        value["n_chars"] = F.when(F.col("n_hit") > 0, F.length("kept")).otherwise(value["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return left.select(*(value[c].alias(c) for c in docs.columns))
