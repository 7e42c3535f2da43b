"""Operator semantics on hand-made rows (FIXTURES.md part 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skywave.operators import callsigns, flags, sampling, signatures, solar, validation
from skywave.sources import readers, schemas

T0 = dt.datetime(2021, 3, 1, 12, 0, 0)


def spot_rows(spark, rows):
    """rows: dicts with any subset of bronze columns."""
    base = dict(id=0, timestamp=T0, reporter="W1", reporter_grid="FN42", snr=-10, frequency=14_097_100, callsign="K1",
                grid="DM79", power=23, drift=0, distance=1000, azimuth=90, band=107, mode="WSPR", version="2.0",
                code=0, column_count=17)
    full = []
    for i, r in enumerate(rows):
        d = dict(base, id=i + 1)
        d.update(r)
        full.append(tuple(d[f.name] for f in schemas.WSPR_SPOT.fields))
    return spark.createDataFrame(full, schemas.WSPR_SPOT)


def solar_rows(spark, rows):
    out = []
    for r in rows:
        d = dict(observed_flux=100.0, adjusted_flux=100.0, ssn=50.0, kp_index=2.0, ap_index=7.0, xray_short=0.0,
                 xray_long=0.0, source_file="f", updated_at=dt.datetime(2026, 1, 1))
        d.update(r)
        out.append(tuple(d.get(f.name) for f in schemas.SOLAR.fields))
    return spark.createDataFrame(out, schemas.SOLAR)


def test_signature_having_and_reliability(spark):
    four = [dict(snr=s) for s in (-20, -19, 0, 5)]
    five = [dict(snr=s, hour_shift=1) for s in (1, 2, 3, 10, -20)]
    rows = four + [dict(snr=d["snr"], timestamp=T0 + dt.timedelta(hours=1)) for d in five]
    sig = signatures.wspr_signatures(spot_rows(spark, rows), None).collect()
    assert len(sig) == 1                      # 4 spots dropped, 5 kept
    r = sig[0]
    assert r.spot_count == 5 and r.hour == 13
    assert r.median_snr == 2.0
    assert r.reliability == pytest.approx(4 / 5)   # snr exactly -20 is not reliable


def test_median_interpolates(spark):
    rows = [dict(snr=s) for s in (1, 2, 3, 10)]
    sig = signatures.wspr_signatures(spot_rows(spark, rows), None, min_spots=1).collect()
    assert sig[0].median_snr == 2.5


def test_unmatched_solar_is_zero_filled(spark):
    rows = [dict(snr=0) for _ in range(5)]
    sol = solar_rows(spark, [dict(date=T0.date() - dt.timedelta(days=1), time=T0 - dt.timedelta(days=1))])
    sig = signatures.wspr_signatures(spot_rows(spark, rows), sol).collect()
    assert sig[0].avg_sfi == 0.0 and sig[0].avg_kp == 0.0


def test_solar_fan_out_raw_vs_bucketed(spark):
    rows = [dict(snr=0) for _ in range(5)]
    sol = solar_rows(spark, [dict(date=T0.date(), time=T0, observed_flux=100.0),
                             dict(date=T0.date(), time=T0 + dt.timedelta(hours=1), observed_flux=200.0)])
    s = spot_rows(spark, rows)
    raw = signatures.wspr_signatures(s, sol, solar_mode="raw").collect()[0]
    bkt = signatures.wspr_signatures(s, sol).collect()[0]
    assert raw.spot_count == 10 and bkt.spot_count == 5        # the reference's fan-out vs one row per spot
    assert raw.avg_sfi == 150.0 and bkt.avg_sfi == 150.0


def test_latest_solar_reading_wins(spark):
    sol = solar_rows(spark, [dict(date=T0.date(), time=T0, observed_flux=100.0, updated_at=dt.datetime(2026, 1, 1)),
                             dict(date=T0.date(), time=T0, observed_flux=120.0, updated_at=dt.datetime(2026, 1, 2))])
    got = solar.solar_latest(sol).collect()
    assert len(got) == 1 and got[0].observed_flux == 120.0


def test_callsign_grid_newest_wins_rx_on_tie(spark):
    rows = [dict(callsign="K1", grid="DM79", reporter="K9", reporter_grid="EN52"),
            dict(callsign="K2", grid="FN31", reporter="K1", reporter_grid="CN87")]   # same day: K1 as TX and as RX
    cg = {r.callsign: r for r in callsigns.callsign_grid(spot_rows(spark, rows)).collect()}
    assert cg["K1"].grid == "CN87"          # RX observation wins the tie
    assert cg["K1"].grid_4 == "CN87" and cg["K1"].last_seen == T0.date()


def test_velocity_threshold_boundary(spark):
    def day(call, n, d):
        return [dict(callsign=call, grid=f"{chr(65 + i // 10)}{chr(65 + i % 10)}00", timestamp=T0 + dt.timedelta(days=d))
                for i in range(n)]
    rows = day("B44", 44, 0) + day("B45", 45, 0) + day("B45", 3, 1)
    vd = flags.velocity_day(spot_rows(spark, rows), 45).collect()
    assert [(r.callsign, r.flag_date, r.daily_grids) for r in vd] == [("B45", T0.date(), 45)]
    # the other day of B45 is kept by the exclusion
    s = spot_rows(spark, rows)
    kept = signatures.exclude_flagged(s, flags.velocity_day(s, 45))
    assert kept.where("callsign = 'B45'").count() == 3


def test_type2_is_anti_join(spark):
    rows = [dict(callsign="K1", grid="DM79"), dict(callsign="0A1", grid="xx12"), dict(callsign="0A1", grid="")]
    s = spot_rows(spark, rows)
    t2 = flags.type2_telemetry(s, callsigns.callsign_grid(s)).collect()
    assert [(r.callsign, r.total_spots, str(r.flag_date)) for r in t2] == [("0A1", 2, "1970-01-01")]


def test_contest_modes_give_two_rows(spark):
    qso = spark.createDataFrame([(T0, 14000, 107, m, "K1", "W1", "", "", "", "", "", "") for m in ["PH"] * 3 + ["RY"] * 3],
                                schemas.CONTEST_QSO)
    cg = spark.createDataFrame([("K1", "DM79", "DM79", 1, T0.date()), ("W1", "FN42", "FN42", 1, T0.date())], schemas.CALLSIGN_GRID)
    sig = signatures.contest_signatures(qso, cg, None, window=("2000-01-01", "2030-01-01")).collect()
    assert sorted(r.median_snr for r in sig) == [0.0, 10.0]
    assert all(r.spot_count == 3 and r.snr_std == 0.0 and r.reliability == 1.0 for r in sig)


def test_windows_half_open_and_inclusive_ranges(spark):
    start, end = dt.datetime(2020, 1, 1), dt.datetime(2026, 2, 4)
    rows = [dict(timestamp=start), dict(timestamp=end), dict(timestamp=start, snr=-35), dict(timestamp=start, snr=25),
            dict(timestamp=start, snr=-36), dict(timestamp=start, snr=26)]
    got = sampling.training_filter(spot_rows(spark, rows)).select("id").collect()
    assert sorted(r.id for r in got) == [1, 3, 4]


def test_score_threshold_boundaries(spark):
    th = validation.seed_mode_thresholds(spark)
    rows = [(m, p) for m, p in [("FT8", -20.0), ("FT8", -20.01), ("CW", -10.0), ("RTTY", -5.0), ("SSB", 5.0),
                                 ("SSB", 4.99), ("DG", 30.0), ("PH", 5.0)]]
    pred = spark.createDataFrame([(m, p, 0.0) for m, p in rows], "actual_mode string, predicted_snr double, actual_snr double")
    got = [(r.actual_mode, r.predicted_snr, r.mode_hit) for r in validation.score_paths(pred, th).collect()]
    assert sorted(got, key=str) == sorted([("FT8", -20.0, 1), ("FT8", -20.01, 0), ("CW", -10.0, 1), ("RTTY", -5.0, 1), ("SSB", 5.0, 1),
                                           ("SSB", 4.99, 0), ("DG", 30.0, None), ("PH", 5.0, 1)], key=str)


def test_dxpedition_window_inclusive(spark):
    start, end = dt.datetime(1999, 1, 1), dt.datetime(1999, 1, 6)
    cat = spark.createDataFrame([("K7X", "ISLAND", "AB12", 1999, 10, start, end)], schemas.CATALOG)
    rbn = spark.createDataFrame([(t, "W1", "K", "NA", 14000, 107, c, "K", "NA", "CQ", 10, 20, "CW")
                                 for t, c in [(start, "K7X"), (end, "K7X"), (end + dt.timedelta(seconds=1), "K7X"), (start, "K8X")]],
                                schemas.RBN_SPOT)
    cg = spark.createDataFrame([("W1", "FN42", "FN42", 1, start.date())], schemas.CALLSIGN_GRID)
    got = signatures.dxpedition_paths(rbn, cat, cg).collect()
    assert sorted(r.timestamp for r in got) == [start, end]


def _dx_case(spark):
    """One file's worth of spots; windows of a callsign overlap, repeat, touch and lack ends."""
    t = lambda h: dt.datetime(1999, 1, 1) + dt.timedelta(hours=h)
    rbn = spark.createDataFrame([(t(h), f"W{h % 3}", "K", "NA", 14000, 107, f"K{h % 2}", "K", "NA", "CQ", h % 7, 20, "CW") for h in range(96)], schemas.RBN_SPOT)
    cat = spark.createDataFrame([(f"K{i % 2}", f"E{i % 3}", ("AB12", "AB12", "CD34")[i % 3], 1999, 1, t(i % 5 * 6), t(i % 5 * 6 + i % 4 * 20)) for i in range(40)]
                                + [("K0", "E", "AB12", 1999, 1, None, t(9)), ("K1", "E", "AB12", 1999, 1, t(9), t(3))], schemas.CATALOG)
    cg = spark.createDataFrame([("W0", "FN42", "FN42", 1, t(0).date()), ("W1", "JO62", "JO62", 1, t(0).date())], schemas.CALLSIGN_GRID)
    return rbn.coalesce(1), cat, cg


def test_dxpedition_paths_of_one_file_arise_in_many_tasks(spark):
    """The joined rows are as in the plain join, and neither one task makes them nor do they move."""
    rbn, cat, cg = _dx_case(spark)
    for days in (5.0, 0.1, 50.0):
        p = signatures.dxpedition_paths(rbn, cat, cg, cell_days=days)
        pairs = [(s.timestamp, s.dx_call, c.entity, c.grid) for s in rbn.collect() if s.de_call != "W2" for c in cat.collect()
                 if c.start_ts and c.callsign == s.dx_call and c.start_ts <= s.timestamp <= c.end_ts]
        assert sorted((r.timestamp, r.dx_call, r.dx_entity, r.dx_grid) for r in p.collect()) == sorted(pairs)
        assert p.select(F.spark_partition_id().alias("p")).distinct().count() > 4


@pytest.mark.parametrize("days", [5.0, 2])
def test_dxpedition_paths_of_one_callsign_and_cell_are_shared_out(spark, days):
    """More windows than a broadcast takes, all of one callsign and day: no task makes most of the paths."""
    t = lambda m: dt.datetime(1999, 1, 4) + dt.timedelta(minutes=m)
    rbn = spark.createDataFrame([(t(m), "W1", "K", "NA", 14000 + m, 107, "K0", "K", "NA", "CQ", 9, 20, "CW") for m in range(400)], schemas.RBN_SPOT)
    cat = spark.createDataFrame([("K0", f"E{i}", "AB12", 1999, 1, t(i), t(i + 300)) for i in range(200)], schemas.CATALOG)
    cg = spark.createDataFrame([("W1", "FN42", "FN42", 1, T0.date())], schemas.CALLSIGN_GRID)
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        p = signatures.dxpedition_paths(rbn.coalesce(1), cat, cg, cell_days=days)
        made = [r["count"] for r in p.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(broadcast, was)
    assert sum(made) == sum(i <= m <= i + 300 for m in range(400) for i in range(200))
    assert len(made) > 8 and max(made) < sum(made) / 4


def test_dxpedition_signatures_of_merged_windows(spark):
    """Windows counted in stretches give the signatures of all (spot, window) pairs, from fewer rows."""
    rbn, cat, cg = _dx_case(spark)
    merged = signatures.merge_windows(cat)
    solar = solar_rows(spark, [dict(date=T0.date(), time=T0, observed_flux=70.0, kp_index=2.0)])
    every = signatures.dxpedition_paths(rbn, cat, cg)
    once = signatures.dxpedition_paths(rbn, merged, cg, spread=signatures.signature_spread())
    assert once.groupBy().sum("windows").first()[0] == every.count() > 2 * once.count()
    assert once.groupBy("timestamp", "dx_call", "dx_grid", "skimmer_call").count().where("count > 1").count() == 0
    rows = lambda p: sorted([round(v, 9) if isinstance(v, float) else v for v in r] for r in signatures.dxpedition_signatures(p, solar).collect())
    assert rows(once) == rows(every)


def test_density_absent_cell_weight(spark):
    sol = solar_rows(spark, [dict(date=T0.date(), time=T0, ssn=50.0)])
    s = spot_rows(spark, [dict(snr=0, grid="FN42", reporter_grid="JO01")])
    empty = spark.createDataFrame([], "ssn_bin int, lat_bin int, cell_count long")
    got = sampling.gold_continuous(s, sol, empty, per_band=5).collect()
    assert got[0].sampling_weight == pytest.approx(1 / 50 ** 0.5)


def test_conform_fills_defaults_and_strips_nul(spark):
    raw = spark.createDataFrame([(1, "K1\u0000\u0000", None)], "id long, callsign string, snr int")
    got = readers.conform_wspr(raw).collect()[0]
    assert got.callsign == "K1" and got.snr == 0 and got.mode == "WSPR" and got.column_count == 15


def test_step_i_compare_equals_pairwise_join(spark):
    rows_a = [(1.0, 2.0, 3.0, 4.0, 14.1, 2000, 1, 5, "CW", o) for o in (1, 1, 0)] + [(9.0, 2.0, 3.0, 4.0, 7.04, 2000, 1, 5, "PH", 1)]
    rows_b = [(1.0, 2.0, 3.0, 4.0, 14.1, 2000, 1, 5, o) for o in (1, 0)] + [(9.0, 2.0, 3.0, 4.0, 7.04, 2000, 1, 5, 1)]
    keys = "tx_lat double, tx_lon double, rx_lat double, rx_lon double, freq_mhz double, year int, month int, hour_utc int"
    a = spark.createDataFrame(rows_a, keys + ", mode string, band_open int")
    b = spark.createDataFrame(rows_b, keys + ", voacap_band_open int")
    got = {r.mode: r for r in validation.step_i_compare(a, b).collect()}
    # CW: 3 x 2 = 6 pairs, matches: opens 2x1 + closed 1x1 = 3
    assert got["CW"].paths == 6 and got["CW"].match_rate == pytest.approx(0.5)
    assert got["CW"].open_rate == pytest.approx(4 / 6) and got["CW"].other_open_rate == pytest.approx(0.5)
    assert got["PH"].paths == 1 and got["PH"].match_rate == 1.0


def test_snr_aggregates_equal_plain_ones(spark):
    import random
    rnd = random.Random(7)
    rows = [(g, rnd.randint(-30, 20)) for g in range(60) for _ in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "g int, snr int")
    h = {r.g: r for r in df.groupBy("g").agg(*signatures._snr_aggs(-20)).collect()}
    ref = {r.g: r for r in df.groupBy("g").agg(F.median("snr").alias("m"), F.stddev_pop("snr").alias("s"),
                                               F.count("*").alias("n"), F.avg((F.col("snr") > -20).cast("int")).alias("rel")).collect()}
    assert set(h) == set(ref)
    for g, r in ref.items():
        assert h[g].spot_count == r.n
        assert h[g].median_snr == r.m
        assert h[g].snr_std == pytest.approx(r.s, abs=1e-9)
        assert h[g].reliability == pytest.approx(r.rel)


def test_quality_metrics_of_a_constant_model(spark):
    paths = spark.createDataFrame([(i, 102 + i % 2, float(i % 7)) for i in range(40)], "path_id long, band int, median_snr double")
    preds = spark.createDataFrame([(i, 5.0 if i % 2 else float(i), float(-i)) for i in range(40)], "path_id long, model_snr double, voacap_snr double")
    m = validation.quality_test_metrics(paths, preds)
    got = {r.band: r for r in m.collect()}
    assert got[103].r_model_snr is None and got[103].winner is None and got[102].r_model_snr is not None
    s = validation.quality_test_summary(m).first()
    assert s.bands == 2 and s.undecided == 1 and s.wins_model_snr + s.wins_voacap_snr == 1 and s.low_band_delta_r is not None


def test_station_profiles(spark):
    pred = spark.createDataFrame([("FT8", -25.0, -20.0)], "actual_mode string, predicted_snr double, actual_snr double")
    th = validation.seed_mode_thresholds(spark)
    assert th.count() == 15
    base = validation.score_paths(pred, th).first()
    portable = validation.score_paths(pred, th, profile="portable").first()
    assert base.ft8_viable == 0 and portable.ft8_viable == 1 and portable.profile == "portable"


def test_pending_files(spark):
    from skywave.operators import reports
    listing = spark.createDataFrame([("new", 5), ("done", 5), ("primed", 5), ("grown", 9)], "file_path string, file_size long")
    log = spark.createDataFrame([("done", 5, 10, 1), ("primed", 5, 0, 1), ("grown", 5, 10, 1)], "file_path string, file_size long, row_count long, loaded_at int")
    names = lambda df: sorted(r.file_path for r in df.collect())
    assert names(reports.pending_files(listing, log)) == ["new"]
    assert names(reports.pending_files(listing, log, reload_primed=True)) == ["new", "primed"]
    assert names(reports.pending_files(listing, log, reload_grown=True)) == ["grown", "new"]


def test_properties_v2_subset_and_union_sum(spark):
    from conftest import SF_MID
    from skywave.plans import catalog
    from skywave.sources import fixtures as fx
    s, summary, cg = catalog._chain(spark, SF_MID)
    fl = flags.balloon_flags_v2(s, cg, summary=summary)
    kept = signatures.exclude_flagged(s, fl).select("id")
    assert kept.join(s.select("id"), "id", "left_anti").count() == 0          # v2 spots are a subset
    assert 0 < kept.count() < s.count()
    parts = {"wspr": catalog._v2(spark, SF_MID), "contest": catalog._contest_sig(spark, SF_MID),
             "rbn": catalog._rbn_sig(spark, SF_MID)}
    u = signatures.union_signatures(**parts)
    assert u.count() == sum(p.count() for p in parts.values())
    assert {r.source for r in u.select("source").distinct().collect()} == set(parts)


def test_conformance_report_flags_bad_rows(spark):
    from skywave.operators import tables
    rows = [dict(snr=-10), dict(snr=200), dict(callsign="K" * 17), dict(reporter_grid="AB12CD34X")]
    s = spot_rows(spark, rows).withColumn("azimuth", F.when(F.col("id") == 1, F.lit(None)).otherwise(F.col("azimuth")))
    rep = {r.name: r for r in tables.conformance_report(s, schemas.WSPR_CONTRACT).collect()}
    assert rep["snr"].out_of_range_rows == 1 and rep["snr"].conforms == 0
    assert rep["callsign"].over_width_rows == 1 and rep["callsign"].max_length == 17
    assert rep["reporter_grid"].over_width_rows == 1
    assert rep["azimuth"].null_rows == 1 and rep["azimuth"].conforms == 0
    assert rep["band"].conforms == 1 and rep["id"].position == 1 and len(rep) == 17
