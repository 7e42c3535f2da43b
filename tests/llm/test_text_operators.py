"""The operators on documents: edge rows, empty tables, brute force."""

import hashlib
import re
import zlib

import pytest

from skywave.llm import chunk_dedup, decontamination, exact_dedup, jaccard_join, kd_sharding, licence_scan, suffix_dedup
from .conftest import SF_TINY, WORDS, edge_rows, prose


def key(t):
    return sorted(map(str, t))


# ---------------------------------------------------------------- exact dedup
def test_exact_dedup_edges(spark, edges, empty):
    got = exact_dedup.groups(edges).collect()
    assert len(got) == len(edge_rows())
    by = {}
    for i, t, *_ in edge_rows():
        by.setdefault(re.sub(r"[ \t-\r]+", " ", t or ""), []).append(i)
    for r in got:
        norm = next(n for n in by if hashlib.sha256(n.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(by[norm]) and r.keep_id == min((x for x in by[norm] if x is not None), default=None)
    assert sum(r.kept for r in got) == len(by)                   # one of the repeated rows, too
    assert exact_dedup.groups(empty).count() == 0
    kept = exact_dedup.deduplicated(edges)
    assert kept.columns == edges.columns and kept.count() == len(by)
    assert exact_dedup.deduplicated(empty).count() == 0


def test_exact_dedup_many_runs(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "concat('t ', id % 7) as text").repartition(40)
    got = exact_dedup.groups(df).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(i, len(range(i, 4000, 7))) for i in range(7)}
    assert sum(r.kept for r in got) == 7


# ---------------------------------------------------------------- sharding
def test_sharding(spark, edges, empty):
    rows = kd_sharding.shards(edges, 5).collect()
    assert len(rows) == len(edge_rows())
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    texts = {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == texts
    assert kd_sharding.shards(empty, 5).count() == 0
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('x', cast(10 + id % 90 as int)) as text", "if(id % 3 = 0, 'hot', cast(id % 5 as string)) as source", "'en' as lang")
    size = {}
    for r in kd_sharding.shards(df, 24).collect():
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert sorted(size) == list(range(24)) and max(size.values()) - min(size.values()) <= 5 * 108
    by_target = kd_sharding.shards(df, target_bytes=20_000).collect()
    assert max(r.shard for r in by_target) + 1 == -(-sum(r.size for r in by_target) // 20_000)


# ---------------------------------------------------------------- decontamination
ITEMS = [("a", prose(1, 120).upper()[:300]), ("b", "one two"), ("c", None), ("d", ""), ("e", "solo"), ("a2", prose(1, 120)[60:400]), ("long", prose(9, 60))]


def brute_hits(text, items):
    words = lambda t: [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))] if False else re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    w, hit, found = words(text), set(), set()
    for name, t in items:
        x = words(t)
        n = min(10, len(x))
        for i in range(len(x) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == x[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(name)
    return len(w), len(hit), sorted(found)


def test_decontamination_edges(spark, edges, empty):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = decontamination.matches(edges, bench).collect()
    want = [(i, *brute_hits(t, ITEMS)) for i, t, *_ in edge_rows()]
    assert key((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == key(want)
    for r in got:
        if r.n_hit == 0:
            assert r.kept in (dict((i, t) for i, t, *_ in edge_rows())[r.doc_id], None)
    assert decontamination.matches(empty, bench).count() == 0
    none = decontamination.matches(edges, bench.limit(0)).collect()
    assert all(r.n_hit == 0 for r in none)
    clean = decontamination.cleaned(edges, bench)
    left = {r.doc_id for r in clean.collect()}
    assert clean.columns == edges.columns and 15 in left and 9 not in left and 7 in left


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_random(spark, seed):
    """Few words, so windows overlap, repeat and share suffixes."""
    import random
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice("ab") for _ in range(n))
    items = [(str(i), text(r.choice([1, 2, 5, 9, 10, 12, 14]) if seed else r.choice([10, 11, 14]))) for i in range(6)]
    docs = [(i, text(r.randrange(0, 60))) for i in range(40)]
    got = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert key((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got.collect()) == key((i, *brute_hits(t, items)) for i, t in docs)


def test_decontamination_in_groups(spark, monkeypatch):
    """A benchmark of many groups, an item in many pieces, another table's column names."""
    monkeypatch.setattr(decontamination, "GROUP_WORDS", 300)
    monkeypatch.setattr(decontamination, "PIECE", 24)
    rows = [(i, t) for i, t, *_ in edge_rows()]
    items = [*ITEMS, ("late", prose(2, 9000)[400:3000]), ("late", prose(2, 9000)[400:3000]), (None, prose(15, 30))]
    docs = spark.createDataFrame(rows + [(21, prose(15, 50))], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert len(decontamination.groups(bench)) > 2
    got = decontamination.matches(docs, bench).collect()
    want = [(i, n, hit, [x for x in names if x]) for i, t in [*rows, (21, prose(15, 50))]
            for n, hit, names in [brute_hits(t, [(x or "", y) for x, y in items])]]
    assert key((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == key(want)
    assert max(hit for _, _, hit, _ in want) > 300


# ---------------------------------------------------------------- substrings
def brute_suffix(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = t.encode()
        gone, again = bytearray(len(b)), []
        for s in range(len(b) - 99):
            k = b[s:s + 100]
            if k in seen:
                again.append(s)
            seen.add(k)
        for s in again:
            gone[s:s + 100] = b"\1" * 100
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_edges(spark, edges, empty):
    got = suffix_dedup.deduplicated(edges).collect()
    assert len(got) == len(edge_rows()) and suffix_dedup.deduplicated(empty).count() == 0
    unique = {i if i is not None else -1: (i, t or "") for i, t, *_ in edge_rows()}
    want = brute_suffix([(k, t) for k, (_, t) in unique.items()])
    assert {(r.doc_id if r.doc_id is not None else -1): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


@pytest.mark.parametrize("seed", range(4))
def test_suffix_dedup_random(spark, seed):
    """Passages of 90 to 400 bytes at any place, periodic text, shared edges."""
    import random
    r = random.Random(seed)
    passages = [prose(100 + i, 60)[:r.choice([90, 99, 100, 101, 130, 250, 400])] for i in range(6)] + ["ab" * 80, "z" * 150]
    rows = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < 0.5 else prose(1000 + seed * 100 + i * 7 + j, r.randrange(1, 30)) for j in range(r.randrange(0, 7))]
        rows.append((i, "".join(p + r.choice(["", " ", "é"]) for p in parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.deduplicated(df, False).collect()}
    assert got == brute_suffix(rows)


def test_chunk_dedup(spark, edges, empty):
    rows = chunk_dedup.report(edges).collect()
    assert len(rows) == len(edge_rows()) and chunk_dedup.report(empty).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[1].n_removed == 0 and by[2].n_removed == by[2].n_bytes and by[8].n_removed > 0.99 * by[8].n_bytes   # shifted by an insertion
    assert by[7].n_removed == by[5].n_removed == by[6].n_removed == by[9].n_removed == 0
    out = {r.doc_id: r.text for r in chunk_dedup.deduplicated(edges).collect()}
    assert out[1] == edge_rows()[0][1] and out[2] == "" and out[5] is None


def test_chunk_cuts_follow_content():
    import numpy as np
    a, b = prose(5, 400).encode(), b"inserted " + prose(5, 400).encode()
    ends = lambda t: [e for _, _, e in chunk_dedup.chunks(np.frombuffer(t, np.uint8), np.array([0, len(t)]))]
    x, y = ends(a), [e - 9 for e in ends(b)]
    assert x[-1] == len(a) and len(set(x) & set(y)) >= len(x) - 3
    assert all(q - p <= chunk_dedup.MOST for p, q in zip([0, *x], x))


# ---------------------------------------------------------------- near duplicates
def brute_components(rows):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for i, t in rows:
        w = (t or "").encode().translate(low).split()
        sets.append((i, {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, s in sets:
        for b, t in sets:
            if a < b and s and 100 * len(s & t) >= 80 * len(s | t):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def test_jaccard_edges(spark, edges, empty):
    got = jaccard_join.near_duplicates(edges).collect()
    assert len(got) == len(edge_rows()) and jaccard_join.near_duplicates(empty).count() == 0
    want = brute_components({i: (i, t) for i, t, *_ in edge_rows() if i is not None}.values())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    kept = jaccard_join.deduplicated(edges)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}


def test_jaccard_repeated_ids(spark):
    """An id with two texts, one a near copy: the other one stays, and one row of each component."""
    base, other = prose(21, 100), prose(22, 100)
    near = base.replace(base.split()[50], "changed", 1)
    rows = [(1, base), (2, near), (2, other), (3, other.replace(other.split()[50], "changed", 1)), (4, prose(23, 80)), (4, prose(23, 80)),
            (5, None), (5, ""), (6, prose(24, 90)), (6, prose(24, 90) + " more")]
    got = [(r.doc_id, r.text) for r in jaccard_join.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert sorted(i for i, _ in got) == [1, 2, 4, 5, 5, 6] and (2, other) in got and (1, base) in got


@pytest.mark.parametrize("seed", range(4))
def test_jaccard_random(spark, seed):
    """Copies with some words changed, around the threshold, of every size, that share a passage."""
    import random
    r = random.Random(seed)
    shared = prose(77, 60)
    rows = []
    for g in range(12):
        base = prose(500 + seed * 50 + g, r.choice([3, 5, 6, 8, 12, 20, 40, 90, 200, 500])).split()
        for _ in range(r.randrange(1, 9)):
            w = list(base)
            for _ in range(r.randrange(0, max(2, len(w) // 25))):
                w[r.randrange(len(w))] = r.choice(WORDS) + "!"
            if r.random() < 0.3:
                w = w[:int(len(w) * r.uniform(0.75, 1))]
            text = " ".join(w)
            rows.append((len(rows), text + " " + shared if len(w) > 100 else text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_jaccard_pieces_leave_room():
    """Set pieces of the largest sets of a band nearly always exceed the difference."""
    import numpy as np
    rng = np.random.Generator(np.random.PCG64(3))
    for band in range(3, 14):
        n = int(jaccard_join.EDGES[band + 1]) - 1
        need = 20 * 2 * n // 180 + 1
        few = 0
        for _ in range(200):
            h = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            own = len(np.unique(((h >> np.uint64(32)) * np.uint64(jaccard_join.pieces(band))) >> np.uint64(32)))
            few += own < need
        assert few <= 6, (band, n, few)


# ---------------------------------------------------------------- licences
def test_licence_scan(spark, edges, empty):
    assert [r.n_matches for r in licence_scan.scan(edges).collect()] == [0] * len(edge_rows())
    assert licence_scan.scan(empty).count() == 0
    mit = licence_scan.TEMPLATES["MIT-grant"]
    rows = [(1, "Some text. Released under the MIT license. More text"), (2, "x\n" + mit.replace("free of charge", "FREE of charge") + "\ny"),
            (3, "all rights"), (4, "ALL RIGHTS RESERVED\nAll rights reserved"), (5, None), (6, "the license of the mit is a released one")]
    got = {r.doc_id: (r.n_matches, r.licences, r.best_licence) for r in licence_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, ["MIT"], "MIT"), 2: (2, ["MIT-grant"], "MIT-grant"), 3: (0, [], None), 4: (2, ["all-rights-reserved"], "all-rights-reserved"),
                   5: (0, [], None), 6: (0, [], None)}


def test_licence_notices_inside_other_words(spark):
    """Notices anywhere in a line, against a plain search: every window with as many words as the template."""
    import random
    rng = random.Random(8)
    notices = list(licence_scan.TEMPLATES.items())
    rows = [(1, "(c) 2020 Foo Ltd, all rights reserved."), (2, "Foo is released under the MIT License, see file COPYING."),
            (3, "see the license under the public software rights"), (4, "reserved"), (5, "license")]
    for i, (name, text) in enumerate(notices):
        w = text.split()
        for k in range(1 + (len(w) > 30)):                              # whole, and with three words changed
            w2 = list(w)
            for j in rng.sample(range(len(w)), 3 * k):
                w2[j] = "zebra"
            rows.append((100 + 2 * i + k, " ".join(rng.choices(WORDS, k=rng.randrange(60))) + " " + " ".join(w2) + " " + " ".join(rng.choices(WORDS, k=rng.randrange(1, 60)))))
    got = {r.doc_id: r for r in licence_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        best = {}
        words = licence_scan.words_of(text)
        for name, template in notices:
            g, n = set(licence_scan.bigrams(template)), len(licence_scan.words_of(template))
            for start in range(max(len(words) - n, 0) + 1):
                h = set(licence_scan.bigrams(" ".join(words[start:start + n])))
                best[name] = max(best.get(name, 0), 2 * len(g & h) / (len(g) + len(h)))
        found = {name for name, dice in best.items() if dice >= 0.8}
        assert found <= set(got[i].licences), (i, found, got[i].licences)
        if i >= 100:
            assert notices[(i - 100) // 2][0] in got[i].licences
    assert got[1].licences == ["all-rights-reserved"] and got[2].licences == ["MIT"] and got[1].best_dice == got[2].best_dice == 1.0
    assert [m.words for m in got[2].matches] == ["released under the mit license"]
    assert got[3].n_matches == got[4].n_matches == got[5].n_matches == 0


def test_licence_required_words_are_necessary():
    """Any subset of a template's bigrams that can still match holds a required word."""
    import itertools
    grams = {k: licence_scan.bigrams(v) for k, v in licence_scan.TEMPLATES.items()}
    words = licence_scan.required_words(grams, 0.8)
    for b in grams.values():
        without = [g for g in b if not any(w in g.split() for w in words)]
        assert len(without) < 0.8 / 1.2 * len(b)
        assert all(len(c) < len(b) for c in itertools.islice(itertools.combinations(without, len(without)), 1))
