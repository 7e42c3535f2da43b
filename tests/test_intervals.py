"""Interval joins, metrics of several grouping sets and sketched distinct counts."""

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from skywave.operators import intervals, reports, validation
from skywave.operators.intervals import interval_join, interval_join_blocks, lookup_band
from skywave.plans import catalog
from skywave.sources import fixtures as fx
from skywave.streaming import rollups


@pytest.mark.parametrize("width,levels", [(0.5, 1), (3, 1), (3, 2), (3, 4), (1000, 2)])
@pytest.mark.parametrize("keyed", [False, True])
def test_interval_join_equals_brute_force(spark, width, levels, keyed):
    r = random.Random(int(width * 7) + levels)
    points = [(i, r.choice("ab") if i % 9 else None, r.choice([None, r.randrange(-60, 300), r.randrange(-60, 300)])) for i in range(150)] + [(150, "a", 7), (151, "a", 7)]
    spans = []
    for i in range(60):
        lo = r.randrange(-60, 280)
        spans.append((i, r.choice("ab"), lo, lo + r.choice([-2, 0, 1, 5, 23, 24, 25, 250])))
    spans += [(90, "a", None, 5), (91, "b", 5, None), (92, None, 0, 100), (93, "a", 7, 7)]
    p = spark.createDataFrame(points, "id int, k string, x int")
    s = spark.createDataFrame(spans, "span int, key string, lo int, hi int")
    got = interval_join(p, s, "x", "lo", "hi", width, levels, [("k", "key")] if keyed else ())
    assert got.columns == ["id", "k", "x", "span", "key", "lo", "hi"]
    want = [(i, j) for i, k, x in points for j, key, lo, hi in spans
            if None not in (x, lo, hi) and lo <= x <= hi and (not keyed or (k is not None and k == key))]
    assert sorted((a.id, a.span) for a in got.collect()) == sorted(want) and len(want) > 50


def test_interval_join_is_an_equi_join(spark):
    """A hot key with thousands of windows: spots meet the windows near them."""
    p = spark.range(3000).selectExpr("id", "'K1' as k", "id * 100 as x")
    s = spark.range(3000).selectExpr("'K1' as key", "id * 100 as lo", "id * 100 + 150 as hi")
    got = interval_join(p, s, "x", "lo", "hi", 150, on=[("k", "key")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == 3000 + 2999
    empty = interval_join(p.limit(0), s, "x", "lo", "hi", 150)
    assert empty.count() == 0 and interval_join(p, s.limit(0), "x", "lo", "hi", 150).count() == 0


@pytest.mark.parametrize("chunk,blocks", [(1, 1), (3, 8), (4096, 1)])
@pytest.mark.parametrize("keyed", [False, True])
def test_blocks_give_the_rows_of_the_interval_join(spark, monkeypatch, chunk, blocks, keyed):
    """Cells cut into many chunks and parts; rows that come twice, null keys and ends."""
    monkeypatch.setattr(intervals, "CHUNK", chunk)
    monkeypatch.setattr(intervals, "BLOCKS", blocks)
    r = random.Random(chunk)
    points = [(i, r.choice("ab") if i % 9 else None, r.choice([None, r.randrange(-60, 300), r.randrange(-60, 300)])) for i in range(90)] + [(90, "a", 7)] * 3
    spans = [(i, r.choice("abc"), lo := r.randrange(-60, 280), lo + r.choice([-2, 0, 1, 5, 23, 24, 25, 250])) for i in range(40)]
    spans += [(90, "a", None, 5), (91, "b", 5, None), (92, None, 0, 100)] + [(93, "a", 7, 7)] * 2
    p = spark.createDataFrame(points, "id int, k string, x int")
    s = spark.createDataFrame(spans, "span int, key string, lo int, hi int")
    on = [("k", "key")] if keyed else ()
    got, want = interval_join_blocks(p, s, "x", "lo", "hi", 3, 2, on, tasks=4), interval_join(p, s, "x", "lo", "hi", 3, 2, on)
    assert got.columns == want.columns and got.rdd.getNumPartitions() == 4
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and want.count() > 30
    assert interval_join_blocks(p, s.where("span < 0"), "x", "lo", "hi", 3, 2, on, tasks=4).count() == 0


def test_lookup_band_of_any_table(spark):
    spots = spark.createDataFrame([(1, 14_000_000), (2, 14_350_000), (3, 14_350_001), (4, None), (5, 0), (6, 14_100_000)], "id int, frequency long")
    edges = spark.createDataFrame([(7, 14.0, 14.35), (5, 14.1, 14.1), (9, 0.1, 13.9)], "band int, lo_mhz double, hi_mhz double")
    got = {r.id: r.resolved_band for r in lookup_band(spots, edges).collect()}
    assert got == {1: 7, 2: 7, 3: 0, 4: 0, 5: 0, 6: 5}


def test_metrics_of_sets_equal_metrics_of_each(spark):
    scored = catalog._scored(spark, SF_SMALL).persist()
    sets = [["source", "band"], ["hour"], []]
    got = validation.model_metrics_sets(scored, sets)
    ids = {0b001: ["source", "band"], 0b110: ["hour"], 0b111: []}
    found = {(r.set_id, r.source, r.band, r.hour): r for r in got.collect()}
    wanted = 0
    for bits, dims in ids.items():
        for w in validation.model_metrics(scored, dims).collect():
            w = w.asDict()
            r = found[(bits, w.get("source"), w.get("band"), w.get("hour"))]
            assert r.paths == w["paths"] and all(r[c] == pytest.approx(w[c]) for c in ("recall", "rmse", "bias", "mae"))
            wanted += 1
    assert wanted == len(found)
    assert validation.model_metrics_sets(scored.limit(0), [["band"]]).count() == 0
    lost = scored.limit(5).withColumn("mode_hit", F.lit(None).cast("int"))
    assert [r.recall for r in validation.model_metrics_sets(lost, [[], ["band"]]).where("band is null").collect()] == [None]


def test_sketches_merge_within_their_error(spark):
    spots = fx.spots(spark, SF_SMALL)
    parts = [spots.where(F.pmod(F.col("id"), F.lit(5)) == i) for i in range(5)]
    union = rollups.daily_sketches(parts[0])
    for p in parts[1:]:
        union = union.unionByName(rollups.daily_sketches(p))
    merged = rollups.merge_sketches(union).select("day", "band", "mode", F.hll_sketch_estimate("tx_sketch").alias("a"), F.hll_sketch_estimate("rx_sketch").alias("b"))
    rows = merged.join(reports.spots_daily(spots), ["day", "band", "mode"]).collect()
    assert rows and all(abs(r.a - r.unique_tx) <= 0.08 * r.unique_tx and abs(r.b - r.unique_rx) <= 0.08 * r.unique_rx for r in rows)
    many = spark.range(200_000).selectExpr("timestamp'2024-01-01 00:00:00' as timestamp", "1 as band", "'W' as mode",
                                           "cast(id as string) as callsign", "cast(id % 50000 as string) as reporter")
    r = rollups.daily_sketches(many).select(F.hll_sketch_estimate("tx_sketch").alias("a"), F.hll_sketch_estimate("rx_sketch").alias("b")).first()
    assert abs(r.a / 200_000 - 1) < 0.05 and abs(r.b / 50_000 - 1) < 0.05
