"""Hard-negative mining against brute force, and what the zone maps leave out."""

import math
import random

import numpy as np

from skywave.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100):
    own = [(v, l, [math.floor(256 * float(np.float32(x))) for x in e]) for v, e, l in rows
           if v is not None and l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (v, l, q) in enumerate(own):
        if v % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(q, r)), w, m == l) for j, (w, m, r) in enumerate(own) if j != i)
        for ps, p, _ in [x for x in s if x[2]][:5]:
            near = [x for x in s if not x[2] and 30 * -ps <= 100 * -x[0] <= 90 * -ps][:10]
            out += [(v, p, k + 1, w, -ps, -x) for k, (x, w, _) in enumerate(near)]
    return sorted(out)


def result(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def vectors(n, seed, dims=8, spread=0.3):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, dims))
    return [(i, (centre[i % 6] + spread * r.normal(size=dims)).tolist(), int(r.integers(3))) for i in range(n)]


def test_mined_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 16)
    monkeypatch.setattr(H, "GROUP", 4)
    monkeypatch.setattr(H, "CHUNK", 3)
    monkeypatch.setattr(H, "PART", 4)
    rows = vectors(420, 1)
    rows += [(100, [float("nan")] * 8, 1), (200, None, 1), (None, [1.0] * 8, 1), (300, [1.0] * 8, None), (7, [None] * 8, 2), (400, [], 1), (500, [1.0, 2.0], 1),
             (600, [0.0] * 8, 1), (700, [1e30] * 2, 0), (0, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2]), (11, [float("inf")] * 8, 0), (-100, [-1.0] * 8, 2)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(60)]                       # copies: ties by id
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "2 as g", "'x' as q").repartition(6)
    want = brute([r if not r[1] or r[1][0] != 1e30 else (700, [float(2 ** 31 - 1) / 256] * 2, 0) for r in rows if r[0] != 700] + [(700, [8388607.99] * 2, 0)])
    got = result(H.mined(df))
    assert [r for r in got if abs(r[4]) < 1 << 40 and abs(r[5]) < 1 << 40] == [r for r in want if abs(r[4]) < 1 << 40 and abs(r[5]) < 1 << 40]
    assert len(got) == len(want)


def test_no_rows_no_anchors(spark):
    assert H.mined(spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.mined(spark.createDataFrame(vectors(50, 3)[1:], SCHEMA)).count() == 0


def test_zone_maps_leave_blocks_out(spark):
    """Clustered vectors: a window's bounds choose a part of the blocks; the result is the same."""
    rows = vectors(3000, 4, dims=4, spread=0.03)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    blocks = H.write_blocks(df)
    groups = H.anchor_groups(blocks, 100)
    windows = groups.selectExpr("g", "posexplode(ids) as (a, id)").selectExpr("g", "cast(a as long) a", "0L as no", "400L as lo", "600L as hi")
    read = []
    keep = H._best
    try:
        H._best = lambda pairs, *a: read.append(pairs.count()) or keep(pairs, *a)
        H._search(groups, windows, blocks, False, 10).count()
    finally:
        H._best = keep
    assert 0 < read[-1] < 0.8 * blocks.count() * groups.count()
    assert result(H.mined(df)) == brute(rows)


def test_cells_that_follow_on_the_curve_are_neighbours():
    for axes in (2, 3, 4):
        cells = np.stack(np.meshgrid(*[np.arange(4)] * axes, indexing="ij")).reshape(axes, -1).astype(np.uint8)
        key = H.curve(cells)
        assert sorted(key.tolist()) == list(range(4 ** axes))
        on = cells[:, np.argsort(key)].astype(int)
        assert (np.abs(np.diff(on, axis=1)).sum(axis=0) == 1).all()
