"""Golden micro-tests on hand-made rows (edge cases of every Column function)."""

import math

import pytest
from pyspark.sql import functions as F

from skywave import functions as sw
from skywave.functions.solar import conditions_label


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_grid_centres(spark):
    df = spark.createDataFrame([("DM79",), ("AA00",), ("RR99",)], "g string")
    got = df.select(sw.maidenhead_lat("g"), sw.maidenhead_lon("g")).collect()
    assert [tuple(r) for r in got] == [(39.5, -105.0), (-89.5, -179.0), (89.5, 179.0)]


def test_six_and_eight_char_refinement(spark):
    df = spark.createDataFrame([("DM79lv",), ("DM79lv38",), ("DM79",)], "g string")
    p = [r[0] for r in df.select(sw.maidenhead_point("g", 8)).collect()]
    # DM79lv: subsquare l (11) -> lon -106 + 11*5' + 2.5'; v (21) -> lat 39 + 21*2.5' + 1.25'
    assert p[0]["lon"] == pytest.approx(-106 + 11 * 5 / 60 + 2.5 / 60)
    assert p[0]["lat"] == pytest.approx(39 + 21 * 2.5 / 60 + 1.25 / 60)
    assert p[1]["lon"] == pytest.approx(-106 + 11 * 5 / 60 + 3 * 0.5 / 60 + 0.25 / 60)
    assert p[1]["lat"] == pytest.approx(39 + 21 * 2.5 / 60 + 8 * 0.25 / 60 + 0.125 / 60)
    assert (p[2]["lat"], p[2]["lon"]) == (39.5, -105.0)


def test_locator_validation(spark):
    rows = [("DM79lv",), ("dm79",), ("DM7938",), ("DM7",), ("ZZ00",)]
    df = spark.createDataFrame(rows, "g string")
    got = [tuple(r) for r in df.select(sw.is_valid_locator("g"), sw.has_valid_field("g")).collect()]
    assert got == [(True, True), (True, False), (True, True), (False, False), (False, False)]


def test_nul_padding(spark):
    assert one(spark, sw.clean_fixed("c"), [("AB\u0000\u0000",), ("K1ABC",)], "c string") == ["AB", "K1ABC"]


def test_ssn_quintiles(spark):
    vals = [46.0, 46.1, 76.0, 124.0, 153.0, 153.1]
    assert one(spark, sw.ssn_quintile("x"), [(v,) for v in vals], "x double") == [1, 2, 2, 3, 4, 5]


def test_kp_penalty(spark):
    assert one(spark, sw.kp_penalty("k"), [(0.0,), (9.0,)], "k double") == [1.0, 0.0]


def test_lat_bin_truncation_shares_bin_zero(spark):
    from skywave.operators.sampling import _lat_bin
    got = one(spark, _lat_bin(F.col("m"), 10, False), [(-9.9,), (9.9,), (-10.5,), (10.5,)], "m double")
    assert got == [0, 0, -1, 1]
    got = one(spark, _lat_bin(F.col("m"), 10, True), [(-9.9,), (9.9,)], "m double")
    assert got == [-1, 0]


def test_geometry(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 0.0), (10.0, 50.0, 10.0, 40.0)], "a double, b double, c double, d double")
    got = df.select(sw.great_circle_km("a", "b", "c", "d"), sw.azimuth_deg("a", "b", "c", "d")).collect()
    assert got[0][0] == pytest.approx(6371 * math.pi / 180, rel=1e-9)
    assert got[0][1] == pytest.approx(0.0)
    assert got[1][1] == pytest.approx(90.0)
    assert got[2][1] == pytest.approx(180.0)
    assert all(0 <= r[1] < 360 for r in got)


def test_band_helpers(spark):
    got = one(spark, sw.band_freq_mhz("b"), [(102,), (107,), (999,)], "b int")
    assert got == [1.84, 14.10, 14.10]
    got = one(spark, sw.freq_to_band("f", "hz"), [(14_097_100,), (1_838_000,), (50_000_000,)], "f long")
    assert got == [107, 102, 0]
    got = one(spark, sw.freq_to_band("f", "khz"), [(7_040,), (28_100,)], "f long")
    assert got == [105, 111]


def test_hash_is_uniform_and_portable(spark):
    # md5('1') = c4ca4238...; first 8 hex digits as an unsigned 32-bit value
    from skywave.functions.hashing import hash_u32
    assert one(spark, hash_u32("x"), [(1,)], "x long") == [int("c4ca4238", 16)]
    u = one(spark, sw.hash_u("x"), [(i,) for i in range(200)], "x long")
    assert all(0 <= v < 1 for v in u)


def test_conditions_label(spark):
    got = one(spark, conditions_label("k", "x"), [(1.0, 1e-7), (4.0, 1e-7), (5.3, 1e-7), (8.0, 2e-5)], "k double, x double")
    assert got == ["Quiet", "Unsettled", "Storm", "Severe Storm + Radio Blackout"]


def test_mobility_tier(spark):
    from skywave.operators.flags import mobility_tier
    got = one(spark, mobility_tier("g"), [(1,), (9,), (24,), (30,), (45,)], "g long")
    assert got == ["Fixed", "Maritime", "Vehicle", "Unclassified", "Fast"]


def test_ssn_from_sfi(spark):
    got = one(spark, sw.ssn_from_sfi("s"), [(63.7,), (50.0,), (136.4,)], "s double")
    assert got[0] == 0.0 and got[1] == 0.0 and got[2] == pytest.approx(100.0)
