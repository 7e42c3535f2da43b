"""Near duplicates by HyperMinHash, and what both near-duplicate operators compare."""

import random

import numpy as np
import pytest

from skywave.llm import hyperminhash as H
from skywave.llm import jaccard_join, shingles
from skywave.llm.common import components
from .conftest import WORDS, edge_rows, prose


def brute(rows, k):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets, index = {}, {}
    for i, t in rows:
        w = (t or "").encode().translate(low).split()
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        for g in sets[i]:
            index.setdefault(g, []).append(i)
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, s in sets.items():
        met = {}
        for g in s:
            for b in index[g]:
                if b > a:
                    met[b] = met.get(b, 0) + 1
        for b, n in met.items():
            if 100 * n >= 80 * (len(s) + len(sets[b]) - n):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_hyperminhash_edges(spark, edges, empty):
    got = H.near_duplicates(edges).collect()
    assert len(got) == len(edge_rows()) and H.near_duplicates(empty).count() == 0
    want = brute({i: (i, t) for i, t, *_ in edge_rows() if i is not None}.values(), 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def random_rows(seed):
    r = random.Random(seed)
    shared, rows = prose(77, 60), []
    for g in range(12):
        base = prose(500 + seed * 50 + g, r.choice([3, 4, 6, 8, 12, 20, 40, 90, 200, 500, 1500])).split()
        for _ in range(r.randrange(1, 9)):
            w = list(base)
            for _ in range(r.randrange(0, max(2, len(w) // 20))):
                w[r.randrange(len(w))] = r.choice(WORDS) + "!"
            if r.random() < 0.3:
                w = w[:int(len(w) * r.uniform(0.75, 1))]
            text = " ".join(w)
            rows.append((len(rows), text + " " + shared if len(w) > 100 else text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_hyperminhash_random(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(H.near_duplicates(df)) == brute(rows, 4)


def test_estimate_is_corrected_and_unbiased():
    """The mean of many estimates is the similarity, registers being compressed."""
    rng = np.random.Generator(np.random.PCG64(5))
    for n, share in ((40, 0.8), (300, 0.6), (3000, 0.9), (3000, 0.0)):
        both = int(round(n * 2 * share / (1 + share)))
        got = []
        for _ in range(60):
            h = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64) * np.uint64(2)
            x, y = h[:n], np.concatenate((h[:both], h[n:]))
            bits = H.size_class(n)
            got.append(H.estimate(H.registers(x, bits), H.registers(y, bits), n, n, bits)[0])
        assert abs(np.mean(got) - both / (2 * n - both)) < 0.02, (n, share)


def test_collisions_as_counted():
    """Registers of different sets agree as often as worked out (few mantissa bits, to count them)."""
    keep = H.MANTISSA
    try:
        H.MANTISSA = 3
        H._cells.cache_clear(), H._agree.cache_clear()
        rng = np.random.Generator(np.random.PCG64(6))
        agree = np.mean([np.mean(H.registers(a, 7) == H.registers(b, 7)) for a, b in (rng.integers(0, 1 << 63, (2, 4096), dtype=np.uint64) * np.uint64(2) for _ in range(40))])
        assert abs(agree - H.collisions(4096, 4096, 7)) < 0.15 * agree
    finally:
        H.MANTISSA = keep
        H._cells.cache_clear(), H._agree.cache_clear()


def families(n, words, alone):
    """n texts of so many words that differ in one of them (the last one, or any); alone: a word for each."""
    base = [f"w{i}" for i in range(words)]
    r, out = random.Random(words), []
    for i in range(n):
        w = list(base)
        w[-1 if alone == "last" else r.randrange(words)] = f"own{i}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("module", [jaccard_join, H])
@pytest.mark.parametrize("words,alone", [(11, "last"), (12, "last"), (30, "any"), (120, "any")])
def test_comparisons_grow_with_the_group(spark, monkeypatch, module, words, alone):
    """Pairs that reach the comparison of whole sets, and rows of the join before it, grow with a
    group of documents that nearly link or do, not with its square; results equal brute force."""
    sent = []

    def counted(pairs, *a, **b):
        sent.append(pairs.count())
        return keep(pairs, *a, **b)
    keep = shingles.verified
    monkeypatch.setattr(shingles, "verified", counted)
    n = 3000 if words < 120 else 600
    rows = families(n, words, alone)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = result(module.near_duplicates(df))
    assert sum(sent) <= (1 + shingles.HEADS) * n, sent
    assert got == brute(rows, module.WORDS)


def test_long_words_that_a_polynomial_hash_confuses(spark):
    """Thue-Morse words and their complements, of 1,024 and 2,048 bytes, are different words."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = [(1, a[:1024]), (2, b[:1024]), (3, a), (4, b), (5, a[:64]), (6, b[:64]), (7, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for module in (jaccard_join, H):
        assert result(module.near_duplicates(df)) == brute(rows, module.WORDS)


def test_components_in_one_task_or_many(spark):
    r = random.Random(8)
    links = [(r.randrange(-400, 400), r.randrange(-400, 400)) for _ in range(500)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    one, many = ({x.v: x.root for x in components(df, together=n).collect()} for n in (1 << 17, 0))
    assert one == many and {one[1000 + i] for i in range(1, 61)} == {1000}
    assert components(df.limit(0)).count() == 0
