"""The conversation trie against brute force."""

import hashlib
import random
import zlib

from skywave.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, share=100, heads=6):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by.setdefault(c, []).append(((turn is not None, turn or 0), d, role, text))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        seqs[c] = tuple(own.get(c - c % share, [])[:h] + t[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for s in nodes:
        if s:
            kids[s[:-1]] = kids.get(s[:-1], 0) + 1
    for s, m in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] = leaves.get(s[:d], 0) + (s not in kids)
            saved[s[:d]] = saved.get(s[:d], 0) + ((len(m) - 1) * len(s[-1][1]) if s else 0)
    return sorted((min(m), len(s), min(nodes[s[:-1]]) if s else -1, len(m), kids.get(s, 0), leaves[s], saved[s],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(s)).encode()).hexdigest()) for s, m in nodes.items())


def result(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def made(n, seed):
    """Conversations with shared first turns, copies, prefixes of each other, ties and nulls."""
    r, rows = random.Random(seed), [(None, 1, "user", "no id"), (5 * n, None, None, None), (5 * n, None, None, None), (5 * n, 0, "user", "Ünï 😀"), (5 * n, 0, "user", "tie")]
    for c in range(n):
        hot = c % 3 == 0
        for t in range(3 if c % 2 else r.randrange(1, 9)):
            rows.append((c, t if r.random() < 0.97 else None, r.choice(["user", None]), "hot" if hot and t < 2 else r.choice(["a", "bb", "ccc", "", None, "a" * 40])))
    r.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, monkeypatch):
    for n, batch, last in ((60, 4, 16), (900, 64, 200)):
        monkeypatch.setattr(T, "BATCH", batch)
        rows = made(n, n + batch)
        df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as seq", "3 as t", "4 as depth").repartition(5)
        got = T.trie(T.shared_heads(T.sequences(df)), last)
        assert result(got) == brute(rows)


def test_trie_odd_input(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert T.trie(T.shared_heads(T.sequences(none))).count() == 0
    rows = [(7, i, "user", f"turn {i}" * (3000 if i == 2 else 1)) for i in range(2000)] + [(-3, 0, "a", "x"), (-3, 0, "a", "x"), (200, 0, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(T.trie(T.shared_heads(T.sequences(df)))) == brute([r for r in rows if r[0] >= 0] + [(-3, 0, "a", "x"), (-3, 0, "a", "x")])
    same = [(c, t, "user", "same") for c in range(3000) for t in range(8)]       # one group of copies over many batches
    assert result(T.trie(T.shared_heads(T.sequences(spark.createDataFrame(same, SCHEMA).repartition(8))))) == brute(same)
