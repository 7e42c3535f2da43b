"""DuckDB oracle SQL per registered query (same column names and types).

Floating-point outputs are rounded to 4 decimals, as the Spark side reports
them (``registry.finalize``)."""

from __future__ import annotations

from skywave import constants as K
from skywave.plans.sql import (BANDS, SIG_COLS, SIG_ROUNDED, azimuth, gc_km, in_window, reserved_sql, signature_sql, sql)

ORACLE: dict[str, str] = {}
R = 4


def r(x: str, d: int = R) -> str:
    """Two-step rounding (9 then ``d`` decimals), as ``registry.finalize``."""
    return f"CAST(round(CAST(round(CAST({x} AS DOUBLE), 9) AS DECIMAL(38, 9)), {d}) AS DOUBLE)"


SPOT_COLS = ("id, timestamp, reporter, reporter_grid, snr, frequency, callsign, grid, power, drift, distance, azimuth, "
             "band, mode, version, code, column_count")

ORACLE["signatures_v1"] = sql(f"SELECT {SIG_ROUNDED} FROM sig_v1", "sig_v1")
ORACLE["scan_spots"] = sql(f"SELECT {SPOT_COLS} FROM spots", "spots")
ORACLE["scan_rbn"] = sql("SELECT * FROM rbn", "rbn")
ORACLE["scan_contest"] = sql("""
SELECT timestamp, frequency, band, mode, call_1, call_2, '59' AS rst_sent, CAST(l_orderkey % 40 AS VARCHAR) AS exch_sent,
       '59' AS rst_rcvd, CAST(l_partkey % 40 AS VARCHAR) AS exch_rcvd, 'CQ-WW' AS contest, 'cq-ww/' || l_linestatus AS source
FROM (SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST((l_orderkey + l_linenumber) % 4 * 6 AS BIGINT)) AS timestamp,
        CAST(102 + l_partkey % 10 AS INTEGER) AS band,
        CASE l_returnflag WHEN 'A' THEN 'PH' WHEN 'N' THEN 'RY' ELSE 'CW' END AS mode,
        'K' || CAST(l_suppkey % 60 AS VARCHAR) AS call_1, 'W' || CAST(l_linenumber % 4 AS VARCHAR) AS call_2,
        CAST(floor(CAST(CASE WHEN l_partkey % 10 = 0 THEN 1840000 WHEN l_partkey % 10 = 1 THEN 3570000
          WHEN l_partkey % 10 = 2 THEN 5290000 WHEN l_partkey % 10 = 3 THEN 7040000 WHEN l_partkey % 10 = 4 THEN 10140000
          WHEN l_partkey % 10 = 5 THEN 14100000 WHEN l_partkey % 10 = 6 THEN 18100000 WHEN l_partkey % 10 = 7 THEN 21100000
          WHEN l_partkey % 10 = 8 THEN 24920000 ELSE 28130000 END AS BIGINT) / 1000) + l_partkey % 100 AS BIGINT) AS frequency
      FROM lineitem)""")
ORACLE["scan_solar"] = sql(f"""
SELECT date, time, {r('observed_flux')} AS observed_flux, {r('adjusted_flux')} AS adjusted_flux, {r('ssn')} AS ssn,
       {r('kp_index')} AS kp_index, {r('ap_index')} AS ap_index, xray_short,
       xray_long, source_file, updated_at FROM solar_raw""", "solar_raw")
ORACLE["mode_thresholds"] = sql("""
SELECT o.mode, o.adif_mode, t.family, t.threshold_db, t.description, o.observations FROM (
  SELECT mode, CASE mode WHEN 'PH' THEN 'SSB' WHEN 'RY' THEN 'RTTY' ELSE mode END AS adif_mode, count(*) AS observations
  FROM (SELECT mode FROM pskr UNION ALL SELECT tx_mode FROM rbn UNION ALL SELECT mode FROM contest) GROUP BY mode) o
LEFT JOIN thresholds t ON t.mode = o.adif_mode""", "pskr", "rbn", "contest", "thresholds")
ORACLE["schema_upgrade"] = sql("""
SELECT 'WSPR' AS mode, 15 AS column_count, count(*) AS rows, CAST(sum(band) AS BIGINT) AS band_sum FROM spots""", "spots")

ORACLE["clean_callsign"] = sql("""
SELECT callsign, count(*) AS rows, CAST(length(callsign) AS INTEGER) AS length
FROM (SELECT callsign FROM spots UNION ALL SELECT reporter FROM spots) GROUP BY callsign""", "spots")
ORACLE["valid_grid_filter"] = sql("""
SELECT g AS grid, CAST(length(g) >= 4 AND regexp_matches(g, '^[A-R]{2}[0-9]{2}') AS INTEGER) AS valid_field
FROM all_grids""", "all_grids")
ORACLE["grid_validation"] = sql(f"""
SELECT g AS grid, CAST(length(g) AS INTEGER) AS grid_length,
       CAST(regexp_matches(g, '{K.LOCATOR_PATTERN}') AS INTEGER) AS is_valid_format,
       CAST(length(g) >= 4 AND regexp_matches(g, '^[A-R]{{2}}[0-9]{{2}}') AS INTEGER) AS valid_field
FROM all_grids""", "all_grids")

_LONB = "((ascii(upper(substr(g,1,1))) - 65) * 20.0 + (ascii(substr(g,3,1)) - 48) * 2.0 - 180)"
_LATB = "((ascii(upper(substr(g,2,1))) - 65) * 10.0 + (ascii(substr(g,4,1)) - 48) - 90)"
_LON6 = f"CASE WHEN length(g) >= 6 THEN {_LONB} + (ascii(lower(substr(g,5,1))) - 97) * (5.0 / 60) + 2.5 / 60 ELSE {_LONB} + 1.0 END"
_LAT6 = f"CASE WHEN length(g) >= 6 THEN {_LATB} + (ascii(lower(substr(g,6,1))) - 97) * (2.5 / 60) + 1.25 / 60 ELSE {_LATB} + 0.5 END"
_LON8 = (f"CASE WHEN length(g) >= 8 THEN {_LONB} + (ascii(lower(substr(g,5,1))) - 97) * (5.0 / 60) + (ascii(substr(g,7,1)) - 48) * (0.5 / 60) + 0.25 / 60 "
         f"ELSE {_LON6} END")
_LAT8 = (f"CASE WHEN length(g) >= 8 THEN {_LATB} + (ascii(lower(substr(g,6,1))) - 97) * (2.5 / 60) + (ascii(substr(g,8,1)) - 48) * (0.25 / 60) + 0.125 / 60 "
         f"ELSE {_LAT6} END")
ORACLE["grid_centroids"] = sql(f"""
SELECT g AS grid, {r(_LATB + ' + 0.5')} AS lat4, {r(_LONB + ' + 1.0')} AS lon4, {r(_LAT8)} AS lat, {r(_LON8)} AS lon
FROM all_grids WHERE regexp_matches(g, '{K.LOCATOR_PATTERN}')""", "all_grids")

_L4 = lambda g: f"((ascii(upper(substr({g},1,1))) - 65) * 20.0 + (ascii(substr({g},3,1)) - 48) * 2.0 - 180 + 1.0)"
_A4 = lambda g: f"((ascii(upper(substr({g},2,1))) - 65) * 10.0 + (ascii(substr({g},4,1)) - 48) - 90 + 0.5)"
ORACLE["path_geometry"] = sql(f"""
SELECT tx_grid_4, rx_grid_4,
       {r(gc_km(_L4('tx_grid_4'), _A4('tx_grid_4'), _L4('rx_grid_4'), _A4('rx_grid_4')))} AS distance_km,
       {r(azimuth(_L4('tx_grid_4'), _A4('tx_grid_4'), _L4('rx_grid_4'), _A4('rx_grid_4')))} AS azimuth_deg
FROM (SELECT DISTINCT substr(grid, 1, 4) AS tx_grid_4, substr(reporter_grid, 1, 4) AS rx_grid_4 FROM spots
      WHERE length(grid) >= 4 AND regexp_matches(grid, '^[A-R]{{2}}[0-9]{{2}}')
        AND length(reporter_grid) >= 4 AND regexp_matches(reporter_grid, '^[A-R]{{2}}[0-9]{{2}}'))""", "spots")

_EDGES = [(102, 1.800, 2.000), (103, 3.500, 4.000), (104, 5.060, 5.450), (105, 7.000, 7.300), (106, 10.100, 10.150),
          (107, 14.000, 14.350), (108, 18.068, 18.168), (109, 21.000, 21.450), (110, 24.890, 24.990), (111, 28.000, 29.700)]
_F2B = "CASE " + " ".join(f"WHEN frequency * 1e-6 >= {lo} AND frequency * 1e-6 <= {hi} THEN {b}" for b, lo, hi in _EDGES) + " ELSE 0 END"
ORACLE["freq_to_band"] = sql(f"""
SELECT band, CAST({_F2B} AS INTEGER) AS resolved_band, count(*) AS rows FROM pskr GROUP BY 1, 2""", "pskr")
ORACLE["freq_to_band_edges"] = ORACLE["freq_to_band"]
ORACLE["training_filter"] = sql(f"""
SELECT band, count(*) AS rows FROM spots
WHERE {in_window()} AND snr BETWEEN -35 AND 25 AND distance BETWEEN 500 AND 18000
  AND length(grid) >= 4 AND length(reporter_grid) >= 4 GROUP BY band""", "spots")

ORACLE["data_integrity"] = sql("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE frequency = 0) AS zero_frequency,
       count(*) FILTER (WHERE epoch(timestamp) = 0) AS zero_timestamp,
       count(*) FILTER (WHERE callsign = '') AS empty_callsign, count(*) FILTER (WHERE reporter = '') AS empty_reporter,
       count(*) FILTER (WHERE column_count <> 17) AS non_v2_rows, min(timestamp) AS earliest_spot, max(timestamp) AS latest_spot
FROM spots""", "spots")
ORACLE["spots_daily"] = sql(f"""
SELECT CAST(timestamp AS DATE) AS day, band, mode, count(*) AS spot_count, count(DISTINCT callsign) AS unique_tx,
       count(DISTINCT reporter) AS unique_rx, {r('avg(snr)')} AS avg_snr, max(distance) AS max_distance
FROM spots GROUP BY 1, 2, 3""", "spots")

ORACLE["solar_daily"] = sql(f"""
SELECT date, {r('max(observed_flux)')} AS sfi, {r('max(ssn)')} AS ssn, {r('max(kp_index)')} AS kp, {r('max(ap_index)')} AS ap,
       max(xray_short) AS xray_short, max(xray_long) AS xray_long, min(source_file) AS primary_source
FROM solar_latest GROUP BY date""", "solar_latest")
ORACLE["solar_buckets"] = sql(f"""
SELECT sd AS date, CAST(sb AS INTEGER) AS bucket, {r('ssn')} AS ssn, {r('sfi')} AS sfi, {r('kp')} AS kp FROM solar_bkt_max""",
                              "solar_bkt_max")
ORACLE["latest_by_key"] = sql(f"""
SELECT date, time, {r('observed_flux')} AS observed_flux, {r('adjusted_flux')} AS adjusted_flux, {r('ssn')} AS ssn,
       {r('kp_index')} AS kp_index, {r('ap_index')} AS ap_index, xray_short,
       xray_long, source_file, updated_at FROM solar_latest""", "solar_latest")
ORACLE["solar_join_raw"] = sql(f"""
SELECT s.id, s.timestamp, {r('coalesce(l.observed_flux, 0.0)')} AS sfi, {r('coalesce(l.kp_index, 0.0)')} AS kp,
       {r('coalesce(l.ssn, 0.0)')} AS ssn
FROM spots s LEFT JOIN solar_latest l ON CAST(s.timestamp AS DATE) = l.date AND hour(s.timestamp) // 3 = hour(l.time) // 3""",
                               "spots", "solar_latest")
ORACLE["solar_join_bucketed"] = sql(f"""
SELECT s.id, s.timestamp, {r('b.ssn')} AS ssn, {r('b.sfi')} AS sfi, {r('b.kp')} AS kp
FROM spots s JOIN solar_bkt_max b ON CAST(s.timestamp AS DATE) = b.sd AND hour(s.timestamp) // 3 = b.sb""",
                                    "spots", "solar_bkt_max")
ORACLE["solar_coverage"] = sql("""
SELECT min(date) AS first_flux_date, max(date) AS last_flux_date, count(DISTINCT date) AS days_with_flux
FROM solar_raw WHERE observed_flux > 0""", "solar_raw")

ORACLE["callsign_grid"] = sql("SELECT * FROM cg", "cg")
ORACLE["callsign_grid_report"] = sql("""
SELECT count(*) AS total_rows, count(DISTINCT callsign) AS distinct_callsigns,
       count(*) FILTER (WHERE spot_count > 0) AS rows_with_spots FROM cg""", "cg")
ORACLE["velocity_day"] = sql("SELECT * FROM velocity", "velocity")
ORACLE["type2_telemetry"] = sql("SELECT * FROM type2", "type2")
ORACLE["balloon_flags_v2"] = sql("SELECT * FROM flags", "flags")
ORACLE["flag_summary"] = sql("""
SELECT flag_reason, count(*) AS entries, count(DISTINCT callsign) AS callsigns, sum(total_spots)::BIGINT AS flagged_spots,
       (SELECT count(*) FROM spots) AS bronze_rows,
       CAST(round(CAST(round(CAST(sum(total_spots) * 100.0 / (SELECT count(*) FROM spots) AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE)::DOUBLE AS contamination_pct
FROM flags GROUP BY flag_reason""", "flags", "spots")
ORACLE["exclude_type2"] = sql("""
SELECT band, count(*) AS rows FROM spots s
WHERE NOT EXISTS (SELECT 1 FROM type2 f WHERE f.callsign = s.callsign)
  AND NOT EXISTS (SELECT 1 FROM type2 f WHERE f.callsign = s.reporter) GROUP BY band""", "spots", "type2")
ORACLE["exclude_velocity_day"] = sql("""
SELECT band, count(*) AS rows FROM spots s
WHERE NOT EXISTS (SELECT 1 FROM velocity f WHERE f.callsign = s.callsign AND f.flag_date = CAST(s.timestamp AS DATE))
GROUP BY band""", "spots", "velocity")
ORACLE["mobility_tier"] = sql("""
SELECT CASE WHEN dg <= 1 THEN 'Fixed' WHEN dg < 10 THEN 'Maritime' WHEN dg < 25 THEN 'Vehicle'
            WHEN dg >= 45 THEN 'Fast' ELSE 'Unclassified' END AS tier,
       count(*) AS callsign_days, sum(ds)::BIGINT AS spots, count(DISTINCT callsign) AS callsigns
FROM (SELECT callsign, d, count(*) AS dg, sum(n) AS ds FROM v1_daily GROUP BY 1, 2) GROUP BY 1""", "v1_daily")
ORACLE["velocity_tier_v1"] = sql("""
SELECT callsign, flag_reason, max_daily_grids, total_spots::BIGINT AS total_spots, total_grids, first_seen, last_seen
FROM v1_velocity""", "v1_velocity")
ORACLE["type2_telemetry_v1"] = sql("SELECT * FROM v1_type2", "v1_type2")
ORACLE["reserved_prefix_v1"] = sql(reserved_sql(["v1_velocity"]), "spots", "cg", "v1_velocity")
ORACLE["balloon_flags_v1"] = sql(f"""
SELECT callsign, flag_reason, max_daily_grids, total_spots::BIGINT AS total_spots, total_grids, first_seen, last_seen FROM v1_velocity
UNION ALL SELECT * FROM v1_type2
UNION ALL SELECT * FROM ({reserved_sql(['v1_velocity', 'v1_type2'])})""", "spots", "cg", "v1_velocity", "v1_type2")

ORACLE["signatures_v2"] = sql(f"SELECT {SIG_ROUNDED} FROM sig_v2", "sig_v2")
ORACLE["signature_delta"] = sql("""
SELECT a.n AS v1_rows, b.n AS v2_rows, a.n - b.n AS removed, CAST(round(CAST((a.n - b.n) * 100.0 / NULLIF(a.n, 0) AS DECIMAL(38, 9)), 3) AS DOUBLE) AS removed_pct
FROM (SELECT count(*) AS n FROM sig_v1) a, (SELECT count(*) AS n FROM sig_v2) b""", "sig_v1", "sig_v2")
ORACLE["enrich_endpoints"] = sql("""
SELECT c.timestamp, c.band, c.mode, c.call_1, c.call_2, t.grid_4 AS tx_grid_4, x.grid_4 AS rx_grid_4
FROM contest c JOIN cg t ON c.call_1 = t.callsign JOIN cg x ON c.call_2 = x.callsign
WHERE t.grid_4 <> '' AND x.grid_4 <> ''""", "contest", "cg")
ORACLE["endpoint_resolution"] = sql(f"""
SELECT band, count(*) AS rows, count(*) FILTER (WHERE t.callsign IS NOT NULL AND x.callsign IS NOT NULL) AS resolved,
       {r("count(*) FILTER (WHERE t.callsign IS NOT NULL AND x.callsign IS NOT NULL) * 100.0 / count(*)")} AS resolved_pct
FROM rbn b LEFT JOIN (SELECT callsign FROM cg WHERE grid_4 <> '') t ON b.dx_call = t.callsign
LEFT JOIN (SELECT callsign FROM cg WHERE grid_4 <> '') x ON b.de_call = x.callsign GROUP BY band""", "rbn", "cg")
ORACLE["contest_signatures"] = sql(f"SELECT {SIG_ROUNDED} FROM contest_sig", "contest_sig")
ORACLE["rbn_signatures"] = sql(f"SELECT {SIG_ROUNDED} FROM rbn_sig", "rbn_sig")
ORACLE["anchor_counts"] = sql("""
SELECT count(*) AS total, count(*) FILTER (WHERE median_snr = 10) AS ssb, count(*) FILTER (WHERE median_snr = 0) AS rtty
FROM contest_sig""", "contest_sig")
ORACLE["signature_report"] = sql(f"""
SELECT band, count(*) AS signatures, {r('CAST(round(CAST(avg(median_snr) AS DECIMAL(38, 9)), 1) AS DOUBLE)')} AS avg_snr, {r('CAST(round(CAST(avg(spot_count) AS DECIMAL(38, 9)), 0) AS DOUBLE)')} AS avg_spots,
       {r('CAST(round(CAST(avg(avg_distance) AS DECIMAL(38, 9)), 0) AS DOUBLE)')} AS avg_dist_km FROM rbn_sig GROUP BY band""", "rbn_sig")
ORACLE["snr_distribution"] = sql(f"""
SELECT {r('CAST(round(CAST(quantile_cont(median_snr, 0.1) AS DECIMAL(38, 9)), 1) AS DOUBLE)')} AS p10, {r('CAST(round(CAST(quantile_cont(median_snr, 0.5) AS DECIMAL(38, 9)), 1) AS DOUBLE)')} AS p50,
       {r('CAST(round(CAST(quantile_cont(median_snr, 0.9) AS DECIMAL(38, 9)), 1) AS DOUBLE)')} AS p90 FROM rbn_sig""", "rbn_sig")
ORACLE["coverage_metrics"] = sql(f"""
SELECT count(*) AS signatures, count(*) FILTER (WHERE tx_grid_4 = rx_grid_4) AS same_grid,
       {r('CAST(round(CAST(count(*) FILTER (WHERE avg_sfi > 0) * 100.0 / NULLIF(count(*), 0) AS DECIMAL(38, 9)), 1) AS DOUBLE)')} AS solar_pct FROM rbn_sig""", "rbn_sig")
ORACLE["signature_union"] = sql(f"SELECT {SIG_ROUNDED}, source FROM sig_union", "sig_union")
ORACLE["rows_by_band"] = sql("SELECT source, band, count(*) AS rows FROM sig_union GROUP BY 1, 2", "sig_union")
ORACLE["dxpedition_paths"] = sql("SELECT * FROM dx_paths", "dx_paths")
ORACLE["dxpedition_paths_binned"] = ORACLE["dxpedition_paths"]
_DXG = (f"CAST(trunc(round({gc_km(_L4('tx_grid_4'), _A4('tx_grid_4'), _L4('rx_grid_4'), _A4('rx_grid_4'))}, 6)) AS BIGINT) AS avg_distance, "
        f"CAST(trunc(round({azimuth(_L4('tx_grid_4'), _A4('tx_grid_4'), _L4('rx_grid_4'), _A4('rx_grid_4'))}, 6)) AS BIGINT) AS avg_azimuth")
ORACLE["dxpedition_signatures"] = sql(f"""
SELECT {SIG_COLS} FROM (
  SELECT tx_grid_4, rx_grid_4, band, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(month(timestamp) AS INTEGER) AS month,
         CAST(round(CAST(round(CAST(quantile_cont(snr, 0.5) AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS median_snr, count(*) AS spot_count, CAST(round(CAST(round(CAST(stddev_pop(snr) AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS snr_std,
         CAST(1.0 AS DOUBLE) AS reliability, CAST(round(CAST(round(CAST(avg(sfi) AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS avg_sfi, CAST(round(CAST(round(CAST(avg(kp) AS DOUBLE), 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS avg_kp, {_DXG}
  FROM (SELECT p.*, substr(dx_grid, 1, 4) AS tx_grid_4, substr(skimmer_grid, 1, 4) AS rx_grid_4,
               coalesce(b.sfi, 0.0) AS sfi, coalesce(b.kp, 0.0) AS kp
        FROM dx_paths p LEFT JOIN solar_bkt_avg b ON CAST(p.timestamp AS DATE) = b.sd AND hour(p.timestamp) // 3 = b.sb)
  GROUP BY tx_grid_4, rx_grid_4, band, hour(timestamp), month(timestamp)) s, range(2) rep""", "dx_paths", "solar_bkt_avg")

from skywave.plans.sql import SAMPLE_KEY, hash_u32  # noqa: E402

GOLD = f"id, snr, distance, band, hour, month, azimuth, tx_grid, rx_grid, {r('ssn')} AS ssn, {r('sfi')} AS sfi, {r('kp')} AS kp"

ORACLE["hash_sample"] = sql(f"""
SELECT id, band, h AS hash_u32 FROM (SELECT id, band, {hash_u32(SAMPLE_KEY)} AS h FROM spots) ORDER BY h, id LIMIT 1000""", "spots")
ORACLE["gold_stratified"] = sql(f"""
SELECT {GOLD}, ssn_quintile FROM (
  SELECT id, snr, distance, band, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(month(timestamp) AS INTEGER) AS month, azimuth,
         grid AS tx_grid, reporter_grid AS rx_grid, ssn, sfi, kp,
         CASE WHEN ssn <= 46 THEN 1 WHEN ssn <= 76 THEN 2 WHEN ssn <= 124 THEN 3 WHEN ssn <= 153 THEN 4 ELSE 5 END AS ssn_quintile,
         {hash_u32(SAMPLE_KEY)} AS h
  FROM gold_base WHERE band IN ({BANDS}))
QUALIFY row_number() OVER (PARTITION BY band, ssn_quintile ORDER BY h, id) <= 20""", "gold_base")
ORACLE["ifw_density"] = sql("SELECT * FROM density", "density")
ORACLE["density_stats"] = sql("SELECT count(*) AS cells, min(cell_count) AS min_count, max(cell_count) AS max_count FROM density",
                              "density")
_GC = (f"{GOLD}, {r('midpoint_lat')} AS midpoint_lat, {r('sampling_weight')} AS sampling_weight, "
       f"{r('sfi_dist_interact')} AS sfi_dist_interact")
ORACLE["gold_continuous"] = sql(f"SELECT {_GC} FROM gold_cont", "gold_cont")
ORACLE["gold_v6"] = sql(f"SELECT {_GC}, {r('1.0 - kp / 9.0')} AS kp_penalty FROM gold_cont", "gold_cont")
ORACLE["ssn_quintile_bounds"] = sql(f"""
SELECT {r('q[1]')} AS q1, {r('q[2]')} AS q2, {r('q[3]')} AS q3, {r('q[4]')} AS q4
FROM (SELECT quantile_cont(ssn, [0.2, 0.4, 0.6, 0.8]) AS q FROM gold_base)""", "gold_base")

_C = {b: m for b, m in K.BAND_CENTRE_MHZ.items()}
_FREQ = "CASE " + " ".join(f"WHEN band = {b} THEN {m}" for b, m in _C.items()) + f" ELSE {K.DEFAULT_CENTRE_MHZ} END"
ORACLE["quality_test_paths"] = sql(f"""
SELECT path_id, tx_grid_4, rx_grid_4, {r(_A4('tx_grid_4'))} AS tx_lat, {r(_L4('tx_grid_4'))} AS tx_lon,
       {r(_A4('rx_grid_4'))} AS rx_lat, {r(_L4('rx_grid_4'))} AS rx_lon, band, {r(_FREQ)} AS freq_mhz, hour, month, spot_count,
       {r('median_snr')} AS median_snr, {r('snr_std')} AS snr_std, {r('reliability')} AS reliability, {r('avg_sfi')} AS avg_sfi,
       {r('avg_kp')} AS avg_kp, avg_distance, {r('greatest(0.0, (avg_sfi - 63.7) / 0.727)')} AS ssn
FROM qt_paths""", "qt_paths")

ORACLE["score_paths"] = sql(f"""
SELECT source, tx_grid_4, rx_grid_4, band, hour, month, {r('actual_snr')} AS actual_snr, actual_mode,
       {r('predicted_snr')} AS predicted_snr, {r('snr_error')} AS snr_error, ft8_viable, cw_viable, rtty_viable, ssb_viable,
       mode_hit, profile FROM scored""", "scored")
ORACLE["score_paths_portable"] = sql(f"""
SELECT source, tx_grid_4, rx_grid_4, band, hour, month, {r('actual_snr')} AS actual_snr, actual_mode,
       {r('predicted_snr')} AS predicted_snr, {r('snr_error')} AS snr_error, ft8_viable, cw_viable, rtty_viable, ssb_viable,
       mode_hit, profile FROM scored_portable""", "scored_portable")
ORACLE["threshold_usage"] = sql("""
SELECT t.mode, t.family, t.threshold_db, t.description, count(o.mode) AS observations FROM thresholds t LEFT JOIN (
  SELECT CASE mode WHEN 'PH' THEN 'SSB' WHEN 'RY' THEN 'RTTY' ELSE mode END AS mode
  FROM (SELECT mode FROM pskr UNION ALL SELECT tx_mode FROM rbn UNION ALL SELECT mode FROM contest)) o ON o.mode = t.mode
GROUP BY ALL""", "pskr", "rbn", "contest", "thresholds")
ORACLE["model_metrics"] = sql(f"""
SELECT source, band, count(*) AS paths, {r('avg(mode_hit)')} AS recall, {r('sqrt(avg(snr_error * snr_error))')} AS rmse,
       {r('avg(snr_error)')} AS bias, {r('avg(abs(snr_error))')} AS mae FROM scored GROUP BY source, band""", "scored")
ORACLE["model_metrics_sets"] = sql(f"""
SELECT source, band, hour, CAST(grouping(source, band, hour) AS BIGINT) AS set_id, count(*) AS paths, {r('avg(mode_hit)')} AS recall,
       {r('sqrt(avg(snr_error * snr_error))')} AS rmse, {r('avg(snr_error)')} AS bias, {r('avg(abs(snr_error))')} AS mae
FROM scored GROUP BY GROUPING SETS ((source, band, hour), (source, band), (source, hour), (band), ())""", "scored")
ORACLE["band_hour_heatmap"] = sql("SELECT band, " + ", ".join(
    f"{r(f'avg(CASE WHEN hour = {h} THEN mode_hit END)')} AS h{h:02d}" for h in range(24)) + " FROM scored GROUP BY band", "scored")

_QJ = """(SELECT path_id, band, median_snr, median_snr + ((band * 7 + hour * 3) % 11 - 5) AS model_snr,
          CAST((path_id * 13) % 40 - 20 AS DOUBLE) AS voacap_snr FROM qt_paths)"""
_QA = (f"count(*) AS paths, {r('corr(model_snr, median_snr)')} AS r_model_snr, "
       f"{r('sqrt(avg((model_snr - median_snr) * (model_snr - median_snr)))')} AS rmse_model_snr, "
       f"{r('corr(voacap_snr, median_snr)')} AS r_voacap_snr, "
       f"{r('sqrt(avg((voacap_snr - median_snr) * (voacap_snr - median_snr)))')} AS rmse_voacap_snr, "
       "CASE WHEN corr(model_snr, median_snr) > corr(voacap_snr, median_snr) THEN 'model_snr' WHEN corr(model_snr, median_snr) <= corr(voacap_snr, median_snr) THEN 'voacap_snr' END AS winner")
ORACLE["quality_test_metrics"] = sql(f"""
SELECT band, {_QA}, CAST(band IN (102, 103, 104) AS INTEGER) AS low_band FROM {_QJ} GROUP BY band
UNION ALL SELECT 0 AS band, {_QA}, 0 AS low_band FROM {_QJ}""", "qt_paths")

ORACLE["quality_test_summary"] = sql(f"""
SELECT count(*) AS bands, count(*) FILTER (WHERE winner = 'model_snr') AS wins_model_snr,
       count(*) FILTER (WHERE winner = 'voacap_snr') AS wins_voacap_snr, count(*) FILTER (WHERE winner IS NULL) AS undecided,
       {r('avg(CASE WHEN band IN (102, 103, 104) THEN r_m - r_v END)')} AS low_band_delta_r
FROM (SELECT band, corr(model_snr, median_snr) AS r_m, corr(voacap_snr, median_snr) AS r_v,
             CASE WHEN corr(model_snr, median_snr) > corr(voacap_snr, median_snr) THEN 'model_snr' WHEN corr(model_snr, median_snr) <= corr(voacap_snr, median_snr) THEN 'voacap_snr' END AS winner
      FROM {_QJ} GROUP BY band)""", "qt_paths")

_VALID = lambda g: f"length({g}) >= 4 AND regexp_matches({g}, '^[A-R]{{2}}[0-9]{{2}}')"
_FREQH = _FREQ
ORACLE["step_i_compare"] = sql(f"""
SELECT mode, year, count(*) AS paths, {r('avg(CAST(band_open = voacap_band_open AS INTEGER))')} AS match_rate,
       {r('avg(band_open)')} AS open_rate, {r('avg(voacap_band_open)')} AS other_open_rate
FROM (SELECT *, CAST(model_snr >= threshold AS INTEGER) AS band_open, CAST(voacap_snr >= threshold AS INTEGER) AS voacap_band_open
      FROM (SELECT *, CASE mode WHEN 'CW' THEN -10.0 WHEN 'PH' THEN 5.0 ELSE -5.0 END AS threshold
            FROM (SELECT *, list_element(['CW', 'PH', 'RY'], (year + month + hour_utc) % 3 + 1) AS mode
                  FROM (SELECT {_A4('grid')} AS tx_lat, {_L4('grid')} AS tx_lon, {_A4('reporter_grid')} AS rx_lat,
                               {_L4('reporter_grid')} AS rx_lon, {_FREQH} AS freq_mhz, CAST(year(timestamp) AS INTEGER) AS year,
                               CAST(month(timestamp) AS INTEGER) AS month, CAST(hour(timestamp) AS INTEGER) AS hour_utc,
                               avg(snr) AS model_snr, avg(power) - 35.0 AS voacap_snr
                        FROM spots WHERE {_VALID('grid')} AND {_VALID('reporter_grid')}
                        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8))))
GROUP BY mode, year""", "spots")

_VERS = """(SELECT p_brand AS component, p_type AS version, make_timestamp((1735689600 + p_partkey * 60) * 1000000) AS installed_at,
           'user' || CAST(p_partkey % 3 AS VARCHAR) AS installed_by FROM part)"""
ORACLE["latest_versions"] = f"""
SELECT component, arg_max(version, installed_at) AS version, max(installed_at) AS latest_installed_at,
       arg_max(installed_by, installed_at) AS installed_by FROM {_VERS} GROUP BY component"""
ORACLE["recent_versions"] = f"""
SELECT component, version, installed_at FROM {_VERS} ORDER BY installed_at DESC, component, version LIMIT 10"""
ORACLE["latest_config"] = """
SELECT c_mktsegment AS key, c_name AS value, make_timestamp((1735689600 + c_custkey) * 1000000) AS updated_at FROM customer
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey DESC, c_name DESC) = 1"""
ORACLE["pending_files"] = """
WITH listing AS (SELECT url AS file_path, CAST(length(html) AS BIGINT) AS file_size FROM pages
                 UNION ALL SELECT url || '.next', CAST(length(html) AS BIGINT) FROM pages WHERE page_id % 2 = 0)
SELECT l.file_path, l.file_size FROM listing l WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = l.file_path)"""
ORACLE["pending_files_reload"] = """
WITH listing AS (SELECT url AS file_path, CAST(length(html) AS BIGINT) AS file_size FROM pages
                 UNION ALL SELECT url || '.next', CAST(length(html) AS BIGINT) FROM pages WHERE page_id % 2 = 0),
     latest AS (SELECT url AS file_path, CAST(length(html) AS BIGINT) AS file_size, length(html) % 500 AS row_count FROM pages
                QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1)
SELECT l.file_path, l.file_size FROM listing l
WHERE NOT EXISTS (SELECT 1 FROM latest x WHERE x.row_count > 0 AND x.file_path = l.file_path AND x.file_size = l.file_size)"""

from skywave.sources.schemas import WSPR_CONTRACT  # noqa: E402


def _conf_row(pos, name, typ, width, rng):
    rc = "CAST(0 AS BIGINT)"
    if rng is not None:
        lo, hi = rng
        conds = ([f"{name} < {lo}"] if lo is not None else []) + ([f"{name} > {hi}"] if hi is not None else [])
        rc = f"count(*) FILTER (WHERE {' OR '.join(conds)})"
    wc = f"count(*) FILTER (WHERE length({name}) > {width})" if width else "CAST(0 AS BIGINT)"
    ml = f"CAST(max(length({name})) AS BIGINT)" if width else "CAST(NULL AS BIGINT)"
    return (f"SELECT {pos} AS position, '{name}' AS name, '{typ}' AS expected_type, 1 AS present, "
            f"count(*) FILTER (WHERE {name} IS NULL) AS null_rows, {rc} AS out_of_range_rows, {wc} AS over_width_rows, "
            f"{ml} AS max_length FROM spots")


ORACLE["conformance_report"] = sql(
    "SELECT *, CAST(present = 1 AND null_rows = 0 AND out_of_range_rows = 0 AND over_width_rows = 0 AS INTEGER) AS conforms FROM (" +
    " UNION ALL ".join(_conf_row(i, *c) for i, c in enumerate(WSPR_CONTRACT, start=1)) + ")", "spots")
ORACLE["width_check"] = sql("SELECT " + ", ".join(
    f"CAST(max(length({c})) AS BIGINT) AS max_len_{c}" for c in ["reporter", "reporter_grid", "callsign", "grid", "mode", "version"]) +
    " FROM spots", "spots")
ORACLE["row_gates"] = sql("""
SELECT gate, required, seen, CAST(seen >= required AS INTEGER) AS passed FROM (
  SELECT 'callsign_grid' AS gate, CAST(50 AS BIGINT) AS required, (SELECT count(*) FROM cg) AS seen
  UNION ALL SELECT 'balloon_flags_v2', 40, (SELECT count(*) FROM flags)
  UNION ALL SELECT 'spots', 1000, (SELECT count(*) FROM spots))""", "cg", "flags", "spots")
ORACLE["table_inventory"] = sql("""
SELECT 'wspr.bronze' AS dataset, 1 AS present, (SELECT count(*) FROM spots) AS row_count, 17 AS column_count
UNION ALL SELECT 'solar.bronze', 1, (SELECT count(*) FROM orders), 11
UNION ALL SELECT 'rbn.bronze', 1, (SELECT count(*) FROM events), 13
UNION ALL SELECT 'contest.bronze', 1, (SELECT count(*) FROM lineitem), 12
UNION ALL SELECT 'wspr.callsign_grid', 1, (SELECT count(*) FROM cg), 5
UNION ALL SELECT 'pskr.bronze', 1, (SELECT count(*) FROM events), 9
UNION ALL SELECT 'validation.model_results', 0, -1, -1""", "spots", "cg")

import math  # noqa: E402

_TP = 2.0 * math.pi
_MIDLON = f"(({_L4('tx_grid_4')}) + ({_L4('rx_grid_4')})) / 2.0"
ORACLE["signature_features"] = sql(f"""
SELECT tx_grid_4, rx_grid_4, band, hour, month, CAST(avg_distance AS DOUBLE) AS distance, {r(f'log10({_FREQ})')} AS freq_log,
       {r(f'sin(hour * {_TP / 24!r})')} AS hour_sin, {r(f'cos(hour * {_TP / 24!r})')} AS hour_cos,
       {r('sin(radians(avg_azimuth))')} AS az_sin, {r('cos(radians(avg_azimuth))')} AS az_cos,
       {r(f"{_A4('rx_grid_4')} - {_A4('tx_grid_4')}")} AS lat_diff, {r(f"({_A4('tx_grid_4')} + {_A4('rx_grid_4')}) / 2.0")} AS midpoint_lat,
       {r(f'sin(month * {_TP / 12!r})')} AS season_sin, {r(f'cos(month * {_TP / 12!r})')} AS season_cos,
       {r(f'cos((hour + {_MIDLON} / 15.0 - 12.0) * {_TP / 24!r})')} AS day_night_est,
       {r('avg_sfi / 300.0')} AS sfi, {r('1.0 - avg_kp / 9.0')} AS kp_penalty, {r('median_snr')} AS target_snr
FROM sig_v1""", "sig_v1")
ORACLE["quality_distribution"] = sql(f"""
SELECT date_trunc('hour', timestamp) AS hour_start, band, {r('floor(score * 10) / 10.0')} AS quality_bucket, count(*) AS count,
       CAST(sum(distance) AS BIGINT) AS sum_distance, {r('sum(kp_index)')} AS sum_kp, {r('sum(distance) / count(*)')} AS avg_distance,
       {r('sum(kp_index) / count(*)')} AS avg_kp
FROM silver GROUP BY 1, 2, 3""", "silver")
_LABEL = ("CASE WHEN kp_index >= 7.0 THEN 'Severe Storm' WHEN kp_index >= 5.0 THEN 'Storm' WHEN kp_index >= 4.0 THEN 'Unsettled' "
          "ELSE 'Quiet' END || CASE WHEN xray_long >= 1e-05 THEN ' + Radio Blackout' ELSE '' END")
ORACLE["live_conditions"] = sql(f"""
SELECT {r('kp_index')} AS kp_index, {r('ap_index')} AS ap_index, {r('observed_flux')} AS solar_flux, xray_short,
       xray_long, {_LABEL} AS conditions
FROM solar_latest ORDER BY time DESC, updated_at DESC LIMIT 1""", "solar_latest")
ORACLE["live_enrich"] = sql(f"""
SELECT p.timestamp, p.sender_call, p.receiver_call, p.band, p.snr, {r('c.kp_index')} AS kp_index, {r('c.ap_index')} AS ap_index,
       {r('c.solar_flux')} AS solar_flux, c.xray_short, c.xray_long, c.conditions
FROM pskr p LEFT JOIN (
  SELECT date, hour(time) // 3 AS bucket, kp_index, ap_index, observed_flux AS solar_flux, xray_short, xray_long, {_LABEL} AS conditions
  FROM solar_latest QUALIFY row_number() OVER (PARTITION BY date, hour(time) // 3 ORDER BY time DESC, updated_at DESC) = 1) c
ON CAST(p.timestamp AS DATE) = c.date AND hour(p.timestamp) // 3 = c.bucket""", "pskr", "solar_latest")

ORACLE["pskr_ingest"] = sql("SELECT * FROM pskr", "pskr")
ORACLE["stream_quality"] = ORACLE["quality_distribution"]
ORACLE["stream_quality_late"] = ORACLE["quality_distribution"]
ORACLE["stream_spots_daily"] = ORACLE["stream_spots_daily_late"] = ORACLE["spots_daily"]
ORACLE["stream_spots_daily_sketch"] = sql(f"""
SELECT CAST(timestamp AS DATE) AS day, band, mode, count(*) AS spot_count, {r('avg(snr)')} AS avg_snr, max(distance) AS max_distance,
       true AS tx_near, true AS rx_near
FROM spots GROUP BY 1, 2, 3""", "spots")
ORACLE["overwrite_table"] = sql("""
SELECT band, count(*) AS rows, CAST(sum(snr) AS BIGINT) AS sum_snr, CAST(sum(id) AS BIGINT) AS sum_id
FROM spots WHERE band < 108 AND (band <> 105 OR snr > -10) GROUP BY band""", "spots")
ORACLE["stream_live_conditions"] = ORACLE["live_conditions"]
ORACLE["stream_live_enrich"] = ORACLE["live_enrich"]
ORACLE["stream_ingest_log"] = ("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS without_size, CAST(0 AS BIGINT) AS pending FROM events")
ORACLE["signatures_v1_raw"] = sql(f"SELECT {SIG_ROUNDED} FROM (" + signature_sql("""(
  SELECT s.*, coalesce(l.observed_flux, 0.0) AS sfi, coalesce(l.kp_index, 0.0) AS kp FROM spots s LEFT JOIN solar_latest l
  ON CAST(s.timestamp AS DATE) = l.date AND hour(s.timestamp) // 3 = hour(l.time) // 3)""", K.WSPR_MIN_SPOTS) + ")", "spots", "solar_latest")
_CSV = ", ".join("CASE WHEN column_count = 15 THEN 'WSPR' ELSE mode END AS mode" if c.strip() == "mode" else c.strip() for c in SPOT_COLS.split(","))
ORACLE["scan_spots_csv"] = sql(f"SELECT {_CSV} FROM spots WHERE id % 103 <> 0 AND id % 101 <> 0", "spots")
ORACLE["scan_quarantine"] = sql("""
SELECT CASE WHEN id % 103 = 0 THEN 'columns' ELSE 'value' END AS bad, CAST(CASE WHEN id % 103 = 0 THEN 5 ELSE column_count END AS INTEGER) AS columns,
       count(*) AS lines FROM spots WHERE id % 103 = 0 OR id % 101 = 0 GROUP BY ALL""", "spots")

# What is kept incrementally equals what is built from all rows.
ORACLE["pskr_reload"] = ORACLE["pskr_ingest"]
ORACLE["signatures_incremental"] = ORACLE["signatures_v1"]
ORACLE["callsign_grid_incremental"] = ORACLE["callsign_grid"]
ORACLE["stream_quality_compacted"] = ORACLE["stream_quality"]
