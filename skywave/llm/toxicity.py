"""Toxicity by a weighted finite-state grammar over clauses.

A clause's words become symbols (insult, threat, target, negation, reporting
verb, quotation mark, other).  Three small transducers each read the symbols and
give a factor for every insult and threat: a target in the clause strengthens
it, a negation shortly before weakens it, reported speech weakens it; a threat
counts only with a target.  ``compose`` builds their product machine once; a
clause's score is the sum of its matches' weights times the machine's factors.
A document is judged by its strongest clause, the sum of its clauses and the
number of different matched patterns.

Weights are learned: insults are words and word stems (STEMS characters) whose
share of toxic documents clearly exceeds that of clean ones.  They are fitted on
a sample of FIT_ROWS labelled rows at most (chosen by a hash of doc_id), never
on held-out ones (crc32 of doc_id mod 5 = 0).  The logistic curve over the three
figures is fitted on the same rows, each scored with the weights of the other
half.  The sample thins the commoner kind more; a row counts in the curve as one
over its kind's share, so a score means the same whatever was thinned.  Every
document is scored over its whole text.

Cases: null and empty texts match nothing and get the score of a clean text;
without labels of both kinds nothing is learned and the threats alone score;
several labels of a document count as toxic if one does; a null doc_id is never
learned from; repeated rows each get their score; extra columns don't matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skywave.llm.common import mapped

FIT_ROWS = 20_000
STEMS = (4, 5, 6, 7)
#: Least log-likelihood ratio of a feature (one in some 1e4 reaches it by chance) and least log odds.
LEAST_RATIO = 18.0
LEAST_WEIGHT = 2.0
THREAT_WEIGHT = 3.0

# Function words of the grammar in four languages.
TARGETS = frozenset("you your yours yourself he she they them him her tu toi vous ton votre du dich dir ihr euch dein sie usted ustedes ti vosotros".split())
NEGATIONS = frozenset("not never no isn aren wasn don doesn ne pas jamais nicht kein keine nie nunca jamás".split())
REPORTING = frozenset("said says say called calls wrote quoted reported dit disait écrit sagte sagt schrieb dijo dice escribió".split())
THREATS = frozenset("kill hurt destroy murder stab strangle tuer détruire poignarder töten umbringen zerstören matar destruir apuñalar".split())

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;:\n]+")
TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»]")

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = range(7)

Machine = dict[tuple[int, int], tuple[int, float]]


def _target() -> Machine:
    """Strengthens what follows or precedes a target: 1 once a target was read."""
    m = {(s, c): (s, 1.0) for s in (0, 1) for c in range(7)}
    m |= {(0, TARGET): (1, 1.0), (1, INSULT): (1, 1.3), (0, THREAT): (0, 0.0), (1, THREAT): (1, 1.3)}
    return m


def _negation(reach: int = 3) -> Machine:
    """Weakens what comes within so many words after a negation."""
    m = {(s, c): (max(0, s - 1), 0.4 if s and c in (INSULT, THREAT) else 1.0) for s in range(reach + 1) for c in range(7)}
    return m | {(s, NEGATION): (reach, 1.0) for s in range(reach + 1)}


def _reported() -> Machine:
    """Weakens what stands in quotation marks or after a reporting verb."""
    m = {(s, c): (s, 0.6 if s and c in (INSULT, THREAT) else 1.0) for s in range(3) for c in range(7)}
    return m | {(0, REPORT): (1, 1.0), (0, QUOTE): (2, 1.0), (1, QUOTE): (2, 1.0), (2, QUOTE): (0, 1.0)}


def compose(a: Machine, b: Machine) -> Machine:
    """The machine that reads symbols as both do and multiplies their factors."""
    wide = 1 + max(s for s, _ in b)
    return {(s * wide + t, c): (n * wide + m, x * y) for (s, c), (n, x) in a.items() for (t, d), (m, y) in b.items() if c == d}


GRAMMAR: Machine = compose(compose(_target(), _negation()), _reported())


def features(words: set[str]) -> set[str]:
    """Words, and stems as 'stem*'."""
    out = set(words)
    for k in STEMS:
        out.update(w[:k] + "*" for w in words if len(w) > k)
    return out


class Lexicon:
    def __init__(self, weights: dict[str, float]):
        self.words = {w: x for w, x in weights.items() if w[-1] != "*"}
        self.stems = {w[:-1]: x for w, x in weights.items() if w[-1] == "*"}
        self.sizes = sorted({len(w) for w in self.stems})
        self.known = frozenset(self.words) | THREATS

    def weight(self, w: str) -> float:
        x = self.words.get(w, 0.0)
        for k in self.sizes:
            if len(w) > k:
                x = max(x, self.stems.get(w[:k], 0.0))
        return x

    def touches(self, words: set[str]) -> bool:
        if not self.known.isdisjoint(words):
            return True
        return any(not self.stems.keys().isdisjoint([w[:k] for w in words]) for k in self.sizes)

    def figures(self, text: str) -> tuple[float, float, float]:
        """Strongest clause, sum of clauses, different matched patterns."""
        folded = text.lower()
        if not self.touches(set(WORD.findall(folded))):
            return 0.0, 0.0, 0.0
        most = total = 0.0
        matched: set[str] = set()
        for clause in CLAUSE.findall(folded):
            score = self.clause(TOKEN.findall(clause), matched)
            most, total = max(most, score), total + score
        return most, math.log1p(total), math.log1p(len(matched))

    def clause(self, tokens: list[str], matched: set[str]) -> float:
        state, score = 0, 0.0
        if not TARGETS.isdisjoint(tokens):                # a target anywhere in the clause
            state = GRAMMAR[0, TARGET][0]
        for t in tokens:
            x = self.weight(t)
            c = (INSULT if x else THREAT if t in THREATS else TARGET if t in TARGETS else NEGATION if t in NEGATIONS
                 else REPORT if t in REPORTING else QUOTE if t in '"“”«»' else OTHER)
            state, factor = GRAMMAR[state, c]
            if c == INSULT or c == THREAT and factor:
                score += factor * (x or THREAT_WEIGHT)
                matched.add(t)
        return score


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic, half) of labelled rows that are not held out, about so many
    at most, and how many rows one of each kind stands for."""
    y = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
               .groupBy("doc_id").agg(F.max((F.col("toxic").cast("int") > 0).cast("int")).alias("toxic")))
    # as many of the rarer kind as of the other one at most: each has half of the rows
    counts = {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shares = {k: min(1.0, rows / 2 / n) for k, n in counts.items()}
    share = F.coalesce(*(F.when(F.col("toxic") == k, F.lit(x)) for k, x in shares.items()), F.lit(0.0))
    y = y.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # rows ids at most, so this side has a bound: 16 bytes each
    y = F.broadcast(y.select(F.col("doc_id").alias("y_id"), "toxic"))
    known = (docs.select("doc_id", "text").join(y, F.col("doc_id") == F.col("y_id"))
                 .select(F.coalesce("text", F.lit("")).alias("text"), "toxic",
                         F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half")))
    return known, {k: 1 / shares.get(k, 1.0) for k in (0, 1)}


def _counts(batches):
    found: dict[int, Counter] = {k: Counter() for k in range(4)}
    n = Counter()
    for b in batches:
        for text, toxic, half in zip(*(b.column(i).to_pylist() for i in range(3))):
            kind = 2 * half + (toxic > 0)
            n[kind] += 1
            found[kind].update(features(set(WORD.findall(text.lower()))))
    for kind, c in found.items():
        c[""] = n[kind]
        keys = list(c)
        for i in range(0, len(keys), 50_000):
            part = keys[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([kind] * len(part), pa.int32()),
                                              pa.array([c[k] for k in part], pa.int64())], ["feature", "kind", "n"])


def ratio(t: int, c: int, t_all: int, c_all: int) -> float:
    """Log-likelihood ratio of a feature in t of t_all and c of c_all documents
    against equal shares."""
    def part(k: int, n: int, p: float) -> float:
        return (k * math.log(k / (n * p)) if k else 0.0) + ((n - k) * math.log((n - k) / (n * (1 - p))) if n > k else 0.0)
    p = (t + c) / (t_all + c_all)
    return 2 * (part(t, t_all, p) + part(c, c_all, p)) if 0 < p < 1 else 0.0


def _weights(rows, totals: list[int], halves: tuple[int, ...]) -> dict[str, float]:
    """Log odds of the features that toxic documents have clearly more often."""
    t_all, c_all = sum(totals[2 * h + 1] for h in halves), sum(totals[2 * h] for h in halves)
    out = {}
    for name, n in rows:
        t, c = sum(n[2 * h + 1] for h in halves), sum(n[2 * h] for h in halves)
        x = math.log((t + 0.5) / (t_all + 1)) - math.log((c + 0.5) / (c_all + 1))
        if x >= LEAST_WEIGHT and ratio(t, c, t_all, c_all) >= LEAST_RATIO:
            out[name] = x
    return out


def _figures(model):
    def run(batches):
        for b in batches:
            text, toxic, half = (b.column(i).to_pylist() for i in range(3))
            f = [model.value[h].figures(t) for t, h in zip(text, half)]
            yield pa.RecordBatch.from_arrays([*(pa.array([x[j] for x in f], pa.float64()) for j in range(3)), pa.array(toxic, pa.int32())],
                                             ["a", "b", "c", "toxic"])
    return run


def logistic(x: np.ndarray, y: np.ndarray, count: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Coefficients, the last one for the constant, by Newton steps; each row
    counts as so many."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (count * p * (1 - p))[:, None]) + penalty, x.T @ (count * (y - p)) - penalty @ w)
        w += np.clip(step, -5, 5)
    return w


class Model:
    def __init__(self, lexicon: Lexicon, curve: np.ndarray):
        self.lexicon, self.curve = lexicon, curve

    def score(self, text: str | None) -> float:
        return self.curve_at(self.lexicon.figures(text or ""))

    def curve_at(self, figures) -> float:
        z = float(np.dot(figures, self.curve[:-1]) + self.curve[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    spark = docs.sparkSession
    known, stands = sample(docs, labels, rows)
    n = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    counted = known.transform(mapped, _counts, "feature string, kind int, n long").groupBy("feature").agg(*n)
    totals = [0] * 4
    lexicon = []
    # features of the bounded sample that toxic rows have more often, as many as each stands for
    more = (F.col("n1") + F.col("n3")) * stands[1] > (F.col("n0") + F.col("n2")) * stands[0]
    for r in counted.filter((F.col("feature") == "") | (F.col("n1") + F.col("n3") >= 4) & more).collect():
        if r["feature"]:
            lexicon.append((r["feature"], [r[f"n{k}"] for k in range(4)]))
        else:
            totals = [r[f"n{k}"] for k in range(4)]
    if not totals[1] + totals[3] or not totals[0] + totals[2]:
        return Model(Lexicon({}), np.array([0.5, 0.0, 0.0, -2.0]))
    whole = Lexicon(_weights(lexicon, totals, (0, 1)))
    halves = [Lexicon(_weights(lexicon, totals, (1,))), Lexicon(_weights(lexicon, totals, (0,)))]   # of the other half
    shared = spark.sparkContext.broadcast(halves)
    got = known.transform(mapped, _figures(shared), "a double, b double, c double, toxic int").collect()       # rows at most
    x = np.array([[r["a"], r["b"], r["c"]] for r in got])
    y = np.array([float(r["toxic"] > 0) for r in got])
    order = np.lexsort((y, *x.T))
    return Model(whole, logistic(x[order], y[order], np.where(y > 0, stands[1], stands[0])[order]))


def _score(model):
    def run(batches):
        m: Model = model.value
        for b in batches:
            s = [m.score(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, "score"])
    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.transform(mapped, _slim(_score(shared)), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _slim(run):
    def slim(batches):
        for b in run(batches):
            yield b.select(["doc_id", "score"])
    return slim


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs without those that score threshold or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("others"), F.col("text").cast("string").alias("text"))
    out = rows.transform(mapped, _score(shared), StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    return out.filter(F.col("score") < threshold).select(*(F.col("text") if c == "text" else F.col(f"others.`{c}`") for c in docs.columns))
