"""DuckDB SQL twins of the fixture adapters and shared building blocks.

Each query's oracle is ``WITH <needed CTEs> <body>``; ``sql(body, *ctes)``
pulls in dependencies in definition order.  The SQL is written independently
from the Spark code path (plain joins, GROUP BY, QUALIFY) so that the check is
a real second opinion.
"""

from __future__ import annotations

from skywave import constants as K


def _centre_hz(band: str) -> str:
    arms = " ".join(f"WHEN {band} = {b} THEN {int(round(m * 1_000_000))}" for b, m in K.BAND_CENTRE_MHZ.items())
    return f"CAST(CASE {arms} ELSE 14100000 END AS BIGINT)"


def _centre_mhz(band: str) -> str:
    arms = " ".join(f"WHEN {band} = {b} THEN {m}" for b, m in K.BAND_CENTRE_MHZ.items())
    return f"CAST(CASE {arms} ELSE {K.DEFAULT_CENTRE_MHZ} END AS DOUBLE)"


def lon4(g: str) -> str:
    return f"((ascii(upper(substr({g},1,1))) - 65) * 20.0 + (ascii(substr({g},3,1)) - 48) * 2.0 - 180 + 1.0)"


def lat4(g: str) -> str:
    return f"((ascii(upper(substr({g},2,1))) - 65) * 10.0 + (ascii(substr({g},4,1)) - 48) - 90 + 0.5)"


def gc_km(lon1, lat1, lon2, lat2) -> str:
    return (f"(2.0 * {K.EARTH_RADIUS_KM} * asin(least(1.0, sqrt(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)))))")


def azimuth(lon1, lat1, lon2, lat2) -> str:
    y = f"sin(radians(({lon2}) - ({lon1}))) * cos(radians({lat2}))"
    x = (f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) * "
         f"cos(radians(({lon2}) - ({lon1})))")
    d = f"(degrees(atan2({y}, {x})) + 360.0)"
    return f"({d} - 360.0 * floor({d} / 360.0))"


def trunc_long(x: str) -> str:
    return f"CAST(trunc(round({x}, 6)) AS BIGINT)"


def hash_u32(key: str) -> str:
    return f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT)"


BANDS = ", ".join(str(b) for b in K.HF_BANDS)

CTES: dict[str, str] = {}

CTES["spots_hist"] = f"""
SELECT
  l_orderkey * 100000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber AS id,
  CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST((l_orderkey + l_linenumber) % 4 * 6 AS BIGINT)) AS timestamp,
  'W' || CAST(l_linenumber % 3 AS VARCHAR) AS reporter,
  chr(CAST(74 + l_linenumber % 3 AS INTEGER)) || 'M' || CAST(l_linenumber % 3 AS VARCHAR) || '5' AS reporter_grid,
  CAST(trunc(l_quantity) AS INTEGER) - 35 AS snr,
  {_centre_hz('CAST(102 + l_partkey % 10 AS INTEGER)')} + 1400 + l_partkey % 200 AS frequency,
  'K' || CAST(l_suppkey % 50 AS VARCHAR) AS callsign,
  chr(CAST(65 + l_suppkey % 5 AS INTEGER)) || 'N' || CAST(l_suppkey % 5 AS VARCHAR) || '1' AS grid,
  CAST(20 + l_linenumber % 4 * 3 AS INTEGER) AS power,
  CAST(l_partkey % 3 - 1 AS INTEGER) AS drift,
  CAST(floor(l_extendedprice) AS BIGINT) % 20000 AS distance,
  CAST(l_partkey * 37 % 360 AS INTEGER) AS azimuth,
  CAST(102 + l_partkey % 10 AS INTEGER) AS band,
  'WSPR' AS mode, '2.0' AS version, 0 AS code, 17 AS column_count
FROM lineitem"""

_TEL = "user_id % 10 = 9"
CTES["spots_live"] = f"""
SELECT
  event_id * 10 AS id,
  CAST(ts AS TIMESTAMP) - INTERVAL 25 YEAR AS timestamp,
  'W' || CAST(event_id % 3 AS VARCHAR) AS reporter,
  chr(CAST(74 + event_id % 3 AS INTEGER)) || 'M' || CAST(event_id % 3 AS VARCHAR) || '5' AS reporter_grid,
  CAST(trunc(value) AS INTEGER) % 45 - 30 AS snr,
  CASE WHEN event_id % 97 = 0 THEN CAST(0 AS BIGINT)
       ELSE {_centre_hz('CAST(102 + event_id % 10 AS INTEGER)')} + 1400 + event_id % 200 END AS frequency,
  CASE WHEN {_TEL} AND event_id % 2 = 0 THEN '0' || CAST(user_id % 3 AS VARCHAR) || 'T' || chr(CAST(65 + event_id % 4 AS INTEGER))
       WHEN {_TEL} THEN 'Q' || chr(CAST(65 + event_id % 3 AS INTEGER)) || CAST(user_id % 3 AS VARCHAR)
       ELSE 'K' || CAST(user_id % 5 AS VARCHAR) END AS callsign,
  CASE WHEN {_TEL} THEN lower(chr(CAST(65 + event_id % 18 AS INTEGER)) || chr(CAST(65 + user_id % 18 AS INTEGER))
                              || CAST(event_id % 10 AS VARCHAR) || CAST(user_id % 10 AS VARCHAR))
       WHEN user_id % 5 = 3 THEN chr(CAST(65 + event_id % 10 AS INTEGER)) || 'N' || CAST((event_id // 10) % 10 AS VARCHAR) || '1'
       ELSE chr(CAST(65 + user_id % 5 AS INTEGER)) || 'N' || CAST(user_id % 5 AS VARCHAR) || '1' END AS grid,
  23 AS power, 0 AS drift,
  event_id * 97 % 20000 AS distance,
  CAST(event_id * 37 % 360 AS INTEGER) AS azimuth,
  CAST(102 + event_id % 10 AS INTEGER) AS band,
  'WSPR' AS mode, '2.0' AS version, 0 AS code,
  CASE WHEN event_id % 50 = 0 THEN 15 ELSE 17 END AS column_count
FROM events"""

CTES["spots"] = "SELECT * FROM spots_hist UNION ALL SELECT * FROM spots_live"

CTES["solar_raw"] = """
SELECT
  CAST(o_orderdate AS DATE) AS date,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 8 * 3 + o_custkey % 2 AS BIGINT)) AS time,
  CAST(65 + CAST(floor(o_totalprice) AS BIGINT) % 185 AS DOUBLE) AS observed_flux,
  CAST(65 + CAST(floor(o_totalprice) AS BIGINT) % 185 + o_orderkey % 5 AS DOUBLE) AS adjusted_flux,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 200 AS DOUBLE) AS ssn,
  CAST(o_custkey % 28 AS DOUBLE) / 3.0 AS kp_index,
  CAST(o_custkey % 28 * 2 AS DOUBLE) AS ap_index,
  CAST(0.0 AS DOUBLE) AS xray_short,
  CAST(o_orderkey % 20 AS DOUBLE) * 1e-6 AS xray_long,
  'orders_' || o_orderstatus || '.txt' AS source_file,
  make_timestamp(1767225600000000 + o_custkey * 10000000 + o_orderkey) AS updated_at
FROM orders"""

CTES["solar_latest"] = """
SELECT * FROM solar_raw
QUALIFY row_number() OVER (PARTITION BY date, time ORDER BY updated_at DESC) = 1"""

CTES["solar_bkt_avg"] = """
SELECT date AS sd, hour(time) // 3 AS sb, avg(ssn) AS ssn, avg(observed_flux) AS sfi, avg(kp_index) AS kp
FROM solar_latest GROUP BY 1, 2"""

CTES["solar_bkt_max"] = """
SELECT date AS sd, hour(time) // 3 AS sb, max(ssn) AS ssn, max(observed_flux) AS sfi, max(kp_index) AS kp
FROM solar_latest GROUP BY 1, 2"""

CTES["spots_sol"] = """
SELECT s.*, coalesce(b.sfi, 0.0) AS sfi, coalesce(b.kp, 0.0) AS kp
FROM spots s LEFT JOIN solar_bkt_avg b
  ON CAST(s.timestamp AS DATE) = b.sd AND hour(s.timestamp) // 3 = b.sb"""

CTES["rbn"] = f"""
SELECT
  CAST(ts AS TIMESTAMP) - INTERVAL 25 YEAR AS timestamp,
  'W' || CAST(user_id % 3 AS VARCHAR) AS de_call, 'K' AS de_pfx, 'NA' AS de_cont,
  CAST(floor({_centre_hz('CAST(102 + (event_id // 60) % 10 AS INTEGER)')} / 1000) + event_id % 50 AS BIGINT) AS frequency,
  CAST(102 + (event_id // 60) % 10 AS INTEGER) AS band,
  'K' || CAST(event_id % 60 AS VARCHAR) AS dx_call, 'K' AS dx_pfx, 'NA' AS dx_cont, 'CQ' AS spot_type,
  CAST(trunc(value) AS INTEGER) % 120 - 25 AS snr,
  CAST(20 + event_id % 10 AS INTEGER) AS speed,
  CASE event_type WHEN 'view' THEN 'CW' WHEN 'click' THEN 'RTTY' WHEN 'purchase' THEN 'PSK31'
                  WHEN 'signup' THEN '' ELSE 'FT8' END AS tx_mode
FROM events"""

CTES["contest"] = f"""
SELECT
  CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST((l_orderkey + l_linenumber) % 4 * 6 AS BIGINT)) AS timestamp,
  CAST(floor({_centre_hz('CAST(102 + l_partkey % 10 AS INTEGER)')} / 1000) + l_partkey % 100 AS BIGINT) AS frequency,
  CAST(102 + l_partkey % 10 AS INTEGER) AS band,
  CASE l_returnflag WHEN 'A' THEN 'PH' WHEN 'N' THEN 'RY' ELSE 'CW' END AS mode,
  'K' || CAST(l_suppkey % 60 AS VARCHAR) AS call_1,
  'W' || CAST(l_linenumber % 4 AS VARCHAR) AS call_2
FROM lineitem"""

CTES["catalog"] = """
SELECT
  'K' || CAST(c_custkey % 60 AS VARCHAR) AS callsign,
  c_mktsegment AS entity,
  chr(CAST(65 + c_custkey % 18 AS INTEGER)) || chr(CAST(65 + (c_custkey // 18) % 18 AS INTEGER))
    || CAST(c_custkey % 10 AS VARCHAR) || CAST((c_custkey // 10) % 10 AS VARCHAR) AS grid,
  1999 AS year,
  CAST(abs(floor(c_acctbal)) AS BIGINT) AS qsos,
  TIMESTAMP '1999-01-01 00:00:00' + to_days(CAST((c_custkey // 60) % 20 + c_custkey % 20 AS INTEGER)) AS start_ts,
  TIMESTAMP '1999-01-01 00:00:00' + to_days(CAST((c_custkey // 60) % 20 + c_custkey % 20 AS INTEGER)) + to_days(5) AS end_ts
FROM customer"""

CTES["silver"] = f"""
SELECT
  TIMESTAMP '1999-01-01 00:00:00' + to_hours(CAST(vec_id % 48 AS BIGINT)) AS timestamp,
  chr(CAST(65 + vec_id % 18 AS INTEGER)) || chr(CAST(65 + (vec_id // 18) % 18 AS INTEGER)) || CAST(vec_id % 10 AS VARCHAR) || '5' AS tx_grid,
  chr(CAST(65 + (vec_id // 7) % 18 AS INTEGER)) || chr(CAST(65 + vec_id % 18 AS INTEGER)) || CAST((vec_id // 3) % 10 AS VARCHAR) || '4' AS rx_grid,
  {_centre_hz('CAST(102 + label % 10 AS INTEGER)')} AS frequency,
  CAST(102 + label % 10 AS INTEGER) AS band,
  CAST(500 + vec_id * 7 % 15000 AS BIGINT) AS distance,
  CAST(vec_id % 28 AS DOUBLE) / 3.0 AS kp_index,
  0.0 AS xray_flux,
  embedding,
  coalesce(CAST(embedding[4] AS DOUBLE), 0.0) AS score
FROM embeddings"""

# callsign -> newest grid (TX and RX observations, newest last_seen wins; ties RX, spots, grid)
CTES["cg"] = """
SELECT callsign, grid, substr(grid, 1, 4) AS grid_4, spot_count, last_seen FROM (
  SELECT side, cs AS callsign, substr(g, 1, 6) AS grid, count(*) AS spot_count, max(CAST(timestamp AS DATE)) AS last_seen
  FROM (SELECT 0 AS side, callsign AS cs, grid AS g, timestamp FROM spots
        UNION ALL SELECT 1, reporter, reporter_grid, timestamp FROM spots) o
  WHERE length(g) >= 4 AND regexp_matches(g, '^[A-R]{2}[0-9]{2}')
  GROUP BY side, cs, substr(g, 1, 6))
QUALIFY row_number() OVER (PARTITION BY callsign ORDER BY last_seen DESC, side DESC, spot_count DESC, grid ASC) = 1"""

CTES["velocity"] = f"""
SELECT callsign, 'velocity_day' AS flag_reason, d AS flag_date, daily_grids, daily_spots AS total_spots FROM (
  SELECT callsign, CAST(timestamp AS DATE) AS d, count(DISTINCT substr(grid, 1, 4)) AS daily_grids, count(*) AS daily_spots
  FROM spots WHERE regexp_matches(grid, '^[A-R]{{2}}[0-9]{{2}}')
  GROUP BY 1, 2 HAVING count(DISTINCT substr(grid, 1, 4)) >= {K.VELOCITY_GRIDS_PER_DAY})"""

CTES["type2"] = """
SELECT callsign, 'type2_telemetry' AS flag_reason, DATE '1970-01-01' AS flag_date, CAST(0 AS BIGINT) AS daily_grids,
       count(*) AS total_spots
FROM spots s
WHERE NOT EXISTS (SELECT 1 FROM cg WHERE cg.callsign = s.callsign)
  AND NOT EXISTS (SELECT 1 FROM velocity v WHERE v.callsign = s.callsign)
GROUP BY callsign"""

CTES["flags"] = "SELECT * FROM velocity UNION ALL SELECT * FROM type2"

_ORDER = list(CTES)
DEPS: dict[str, list[str]] = {
    "spots": ["spots_hist", "spots_live"],
    "solar_latest": ["solar_raw"],
    "solar_bkt_avg": ["solar_latest"],
    "solar_bkt_max": ["solar_latest"],
    "spots_sol": ["spots", "solar_bkt_avg"],
    "cg": ["spots"],
    "velocity": ["spots"],
    "type2": ["spots", "cg", "velocity"],
    "flags": ["velocity", "type2"],
}


def _closure(names) -> list[str]:
    need: set[str] = set()

    def visit(n):
        if n in need:
            return
        need.add(n)
        for d in DEPS.get(n, []):
            visit(d)
    for n in names:
        visit(n)
    return [n for n in _ORDER if n in need]


def add_cte(name: str, body: str, deps=()) -> None:
    CTES[name] = body
    DEPS[name] = list(deps)
    _ORDER.append(name)


def sql(body: str, *ctes: str) -> str:
    names = _closure(ctes)
    if not names:
        return body.strip()
    with_ = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in names)
    return f"WITH {with_}\n{body.strip()}"


def signature_sql(src: str, min_spots: int) -> str:
    """13-column WSPR signature aggregation over a spot CTE with sfi/kp attached."""
    return f"""
SELECT substr(grid, 1, 4) AS tx_grid_4, substr(reporter_grid, 1, 4) AS rx_grid_4, band,
       CAST(hour(timestamp) AS INTEGER) AS hour, CAST(month(timestamp) AS INTEGER) AS month,
       quantile_cont(snr, 0.5) AS median_snr, count(*) AS spot_count,
       stddev_pop(snr) AS snr_std,
       count(*) FILTER (WHERE snr > {K.RELIABLE_SNR_DB}) / count(*) AS reliability,
       avg(sfi) AS avg_sfi, avg(kp) AS avg_kp,
       CAST(trunc(avg(distance)) AS BIGINT) AS avg_distance, CAST(trunc(avg(azimuth)) AS BIGINT) AS avg_azimuth
FROM {src}
WHERE distance >= {K.MIN_DISTANCE_KM} AND band IN ({BANDS})
GROUP BY 1, 2, 3, 4, 5
HAVING count(*) >= {min_spots}"""

CTES["pskr"] = f"""
SELECT
  CAST(ts AS TIMESTAMP) - INTERVAL 25 YEAR AS timestamp,
  'K' || CAST(user_id % 40 AS VARCHAR) AS sender_call,
  chr(CAST(65 + user_id % 18 AS INTEGER)) || chr(CAST(65 + event_id % 18 AS INTEGER)) || CAST(user_id % 10 AS VARCHAR)
    || CAST(event_id % 10 AS VARCHAR) || lower(chr(CAST(65 + event_id % 24 AS INTEGER))) || lower(chr(CAST(65 + user_id % 24 AS INTEGER))) AS sender_grid,
  'W' || CAST(event_id % 25 AS VARCHAR) AS receiver_call,
  chr(CAST(70 + event_id % 5 AS INTEGER)) || 'N' || CAST(event_id % 10 AS VARCHAR) || '5' AS receiver_grid,
  {_centre_hz('CAST(102 + event_id % 10 AS INTEGER)')} + 1000 + event_id % 2000 AS frequency,
  CAST(102 + event_id % 10 AS INTEGER) AS band,
  CASE event_type WHEN 'click' THEN 'FT4' WHEN 'view' THEN 'CW' ELSE 'FT8' END AS mode,
  CAST(trunc(value) AS INTEGER) % 50 - 30 AS snr
FROM events"""
DEPS["pskr"] = []
_ORDER.append("pskr")

CTES["all_grids"] = """
SELECT DISTINCT g FROM (SELECT grid AS g FROM spots UNION ALL SELECT reporter_grid FROM spots UNION ALL SELECT sender_grid FROM pskr)"""
DEPS["all_grids"] = ["spots", "pskr"]
_ORDER.append("all_grids")


def sol_join(src: str, bkt: str = "solar_bkt_avg", how: str = "LEFT", zero: bool = True) -> str:
    sfi = "coalesce(b.sfi, 0.0)" if zero else "b.sfi"
    kp = "coalesce(b.kp, 0.0)" if zero else "b.kp"
    ssn = "coalesce(b.ssn, 0.0)" if zero else "b.ssn"
    return (f"SELECT x.*, {sfi} AS sfi, {kp} AS kp, {ssn} AS ssn FROM {src} x {how} JOIN {bkt} b "
            f"ON CAST(x.timestamp AS DATE) = b.sd AND hour(x.timestamp) // 3 = b.sb")


FIX_LO, FIX_HI = "1990-01-01", "2030-01-01"


def in_window(col: str = "timestamp", lo: str = FIX_LO, hi: str = FIX_HI) -> str:
    return f"{col} >= TIMESTAMP '{lo}' AND {col} < TIMESTAMP '{hi}'"


add_cte("spots_v2", """
SELECT s.* FROM spots s
WHERE NOT EXISTS (SELECT 1 FROM flags f WHERE f.flag_reason = 'type2_telemetry' AND f.callsign = s.callsign)
  AND NOT EXISTS (SELECT 1 FROM flags f WHERE f.flag_reason = 'type2_telemetry' AND f.callsign = s.reporter)
  AND NOT EXISTS (SELECT 1 FROM flags f WHERE f.flag_reason = 'velocity_day' AND f.callsign = s.callsign
                  AND f.flag_date = CAST(s.timestamp AS DATE))""", ["spots", "flags"])
add_cte("spots_v2_sol", sol_join("spots_v2"), ["spots_v2", "solar_bkt_avg"])

add_cte("contest_e", f"""
SELECT c.*, t.grid_4 AS tx_grid_4, r.grid_4 AS rx_grid_4 FROM contest c
JOIN cg t ON c.call_1 = t.callsign JOIN cg r ON c.call_2 = r.callsign
WHERE t.grid_4 <> '' AND r.grid_4 <> '' AND c.mode IN ('PH', 'RY') AND {in_window('c.timestamp')} AND c.band IN ({BANDS})""",
        ["contest", "cg"])
add_cte("contest_es", sol_join("contest_e"), ["contest_e", "solar_bkt_avg"])

add_cte("rbn_e", f"""
SELECT r.*, t.grid_4 AS tx_grid_4, x.grid_4 AS rx_grid_4 FROM rbn r
JOIN cg t ON r.dx_call = t.callsign JOIN cg x ON r.de_call = x.callsign
WHERE t.grid_4 <> '' AND x.grid_4 <> '' AND r.tx_mode IN ('CW', 'RTTY', 'PSK31', '') AND r.snr BETWEEN -20 AND 80
  AND {in_window('r.timestamp')} AND r.band IN ({BANDS})""", ["rbn", "cg"])
add_cte("rbn_es", sol_join("rbn_e"), ["rbn_e", "solar_bkt_avg"])

_GEO = (f"{trunc_long(gc_km(lon4('tx_grid_4'), lat4('tx_grid_4'), lon4('rx_grid_4'), lat4('rx_grid_4')))} AS avg_distance, "
        f"{trunc_long(azimuth(lon4('tx_grid_4'), lat4('tx_grid_4'), lon4('rx_grid_4'), lat4('rx_grid_4')))} AS avg_azimuth")

add_cte("contest_sig", f"""
SELECT tx_grid_4, rx_grid_4, band, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(month(timestamp) AS INTEGER) AS month,
  CAST(CASE mode WHEN 'PH' THEN 10.0 WHEN 'RY' THEN 0.0 END AS DOUBLE) AS median_snr, count(*) AS spot_count,
  CAST(0.0 AS DOUBLE) AS snr_std, CAST(1.0 AS DOUBLE) AS reliability, avg(sfi) AS avg_sfi, avg(kp) AS avg_kp,
  {_GEO}
FROM contest_es GROUP BY tx_grid_4, rx_grid_4, band, hour(timestamp), month(timestamp), mode
HAVING count(*) >= {K.CONTEST_MIN_SPOTS}""", ["contest_es"])

add_cte("rbn_sig", f"""
SELECT tx_grid_4, rx_grid_4, band, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(month(timestamp) AS INTEGER) AS month,
  quantile_cont(snr, 0.5) AS median_snr, count(*) AS spot_count, stddev_pop(snr) AS snr_std,
  CAST(1.0 AS DOUBLE) AS reliability, avg(sfi) AS avg_sfi, avg(kp) AS avg_kp,
  {_GEO}
FROM rbn_es GROUP BY tx_grid_4, rx_grid_4, band, hour(timestamp), month(timestamp)
HAVING count(*) >= {K.RBN_MIN_SPOTS}""", ["rbn_es"])

add_cte("sig_v1", signature_sql("spots_sol", K.WSPR_MIN_SPOTS), ["spots_sol"])
add_cte("sig_v2", signature_sql("spots_v2_sol", K.WSPR_MIN_SPOTS), ["spots_v2_sol"])

SIG_COLS = ("tx_grid_4, rx_grid_4, band, hour, month, median_snr, spot_count, snr_std, reliability, avg_sfi, avg_kp, "
            "avg_distance, avg_azimuth")
add_cte("sig_union", f"""
SELECT {SIG_COLS}, 'wspr' AS source FROM sig_v2 UNION ALL
SELECT {SIG_COLS}, 'contest' FROM contest_sig UNION ALL
SELECT {SIG_COLS}, 'rbn' FROM rbn_sig""", ["sig_v2", "contest_sig", "rbn_sig"])

add_cte("dx_paths", f"""
SELECT r.timestamp, r.dx_call, c.entity AS dx_entity, c.grid AS dx_grid, r.de_call AS skimmer_call, g.grid AS skimmer_grid,
       r.band, r.frequency, r.snr, r.tx_mode, 'rbn-dxpedition-synthesis' AS source_type
FROM rbn r JOIN catalog c ON r.dx_call = c.callsign AND r.timestamp BETWEEN c.start_ts AND c.end_ts
JOIN cg g ON r.de_call = g.callsign WHERE g.grid_4 <> ''""", ["rbn", "catalog", "cg"])

add_cte("v1_daily", """
SELECT callsign, CAST(timestamp AS DATE) AS d, substr(grid, 1, 4) AS g4, count(*) AS n FROM spots
WHERE regexp_matches(grid, '^[A-R]{2}[0-9]{2}') GROUP BY 1, 2, 3""", ["spots"])
add_cte("v1_velocity", f"""
SELECT p.callsign, 'velocity_tier' AS flag_reason, max(dg) AS max_daily_grids, sum(ds) AS total_spots,
       (SELECT count(DISTINCT g4) FROM v1_daily x WHERE x.callsign = p.callsign) AS total_grids,
       min(d) AS first_seen, max(d) AS last_seen
FROM (SELECT callsign, d, count(*) AS dg, sum(n) AS ds FROM v1_daily GROUP BY 1, 2) p
GROUP BY p.callsign HAVING max(dg) >= {K.VELOCITY_GRIDS_PER_DAY}""", ["v1_daily"])
add_cte("v1_type2", """
SELECT callsign, 'type2_telemetry' AS flag_reason, CAST(0 AS BIGINT) AS max_daily_grids, count(*) AS total_spots,
       count(DISTINCT substr(grid, 1, 4)) AS total_grids, min(CAST(timestamp AS DATE)) AS first_seen,
       max(CAST(timestamp AS DATE)) AS last_seen
FROM spots s WHERE NOT EXISTS (SELECT 1 FROM cg WHERE cg.callsign = s.callsign)
  AND NOT EXISTS (SELECT 1 FROM v1_velocity v WHERE v.callsign = s.callsign)
GROUP BY callsign""", ["spots", "cg", "v1_velocity"])


def reserved_sql(exclude_ctes) -> str:
    ex = " ".join(f"AND NOT EXISTS (SELECT 1 FROM {c} e WHERE e.callsign = s.callsign)" for c in exclude_ctes)
    return f"""
SELECT callsign, 'reserved_prefix' AS flag_reason, CAST(0 AS BIGINT) AS max_daily_grids, count(*) AS total_spots,
       count(DISTINCT substr(grid, 1, 4)) AS total_grids, min(CAST(timestamp AS DATE)) AS first_seen,
       max(CAST(timestamp AS DATE)) AS last_seen
FROM spots s WHERE (regexp_matches(callsign, '^Q') OR regexp_matches(callsign, '^[0-9]{{2}}'))
  AND NOT EXISTS (SELECT 1 FROM cg WHERE cg.callsign = s.callsign) {ex}
GROUP BY callsign"""


SIG_ROUNDED = ("tx_grid_4, rx_grid_4, band, hour, month, CAST(round(CAST(round(median_snr, 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS median_snr, spot_count, "
               "CAST(round(CAST(round(snr_std, 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS snr_std, CAST(round(CAST(round(reliability, 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS reliability, "
               "CAST(round(CAST(round(avg_sfi, 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS avg_sfi, CAST(round(CAST(round(avg_kp, 9) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS avg_kp, avg_distance, avg_azimuth")

add_cte("gold_base", f"""
SELECT s.*, b.ssn, b.sfi, b.kp FROM spots s JOIN solar_bkt_max b
  ON CAST(s.timestamp AS DATE) = b.sd AND hour(s.timestamp) // 3 = b.sb
WHERE {in_window('s.timestamp')} AND s.snr BETWEEN -35 AND 25 AND s.distance BETWEEN 500 AND 18000
  AND length(s.grid) >= 4 AND length(s.reporter_grid) >= 4""", ["spots", "solar_bkt_max"])

SAMPLE_KEY = "concat_ws('|', CAST(epoch_us(timestamp) AS VARCHAR), callsign, reporter, grid, reporter_grid, CAST(id AS VARCHAR))"
MIDLAT = ("(((ascii(substr(grid,2,1)) - 65) * 10 + (ascii(substr(grid,4,1)) - 48) + (ascii(substr(reporter_grid,2,1)) - 65) * 10"
          " + (ascii(substr(reporter_grid,4,1)) - 48)) / CAST(2.0 AS DOUBLE) - 90 + 0.5)")

add_cte("density", f"""
SELECT CAST(CAST(trunc(ssn) AS BIGINT) // 20 AS INTEGER) AS ssn_bin, CAST(CAST(trunc({MIDLAT}) AS INTEGER) // 10 AS INTEGER) AS lat_bin,
       count(*) AS cell_count
FROM (SELECT * FROM gold_base WHERE band = {K.DENSITY_SAMPLE_BAND}
      ORDER BY {hash_u32(SAMPLE_KEY)}, id LIMIT 2000)
GROUP BY 1, 2""", ["gold_base"])

add_cte("gold_cont", f"""
SELECT id, snr, distance, band, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(month(timestamp) AS INTEGER) AS month, azimuth,
       grid AS tx_grid, reporter_grid AS rx_grid, ssn, sfi, kp, {MIDLAT} AS midpoint_lat, 1.0 / sqrt(cell) AS sampling_weight,
       sfi * log10(CAST(greatest(distance, 1) AS DOUBLE)) AS sfi_dist_interact
FROM (SELECT g.*, CAST(greatest(coalesce(d.cell_count, 0), 50) AS DOUBLE) AS cell,
             ln(1e-18 + {hash_u32("concat_ws('|', CAST(epoch_us(timestamp) AS VARCHAR), grid, reporter_grid, CAST(id AS VARCHAR))")} / 4294967296.0)
               * sqrt(CAST(greatest(coalesce(d.cell_count, 0), 50) AS DOUBLE)) AS es_key
      FROM gold_base g LEFT JOIN density d
        ON d.ssn_bin = CAST(CAST(trunc(g.ssn) AS BIGINT) // 20 AS INTEGER)
       AND d.lat_bin = CAST(CAST(trunc({MIDLAT.replace('grid', 'g.grid').replace('reporter_g.grid', 'g.reporter_grid')}) AS INTEGER) // 10 AS INTEGER)
      WHERE g.band IN ({BANDS}))
QUALIFY row_number() OVER (PARTITION BY band ORDER BY es_key DESC, id) <= 200""", ["gold_base", "density"])

add_cte("sig_pred", """
SELECT CASE WHEN band % 2 = 0 THEN 'rbn' ELSE 'pskr' END AS source, tx_grid_4, rx_grid_4, band, hour, month,
       median_snr AS actual_snr,
       CASE WHEN month = 12 THEN 'DG' ELSE list_element(['FT8', 'CW', 'RTTY', 'SSB'], hour % 4 + 1) END AS actual_mode,
       CAST(median_snr + ((band * 7 + hour * 3) % 11 - 5) AS DOUBLE) AS predicted_snr, avg_sfi, avg_kp
FROM sig_v1""", ["sig_v1"])

THRESHOLDS_VALUES = "SELECT * FROM (VALUES " + ", ".join(
    f"('{m}', '{f}', CAST({t} AS DOUBLE), '{d}')" for m, f, t, d in K.MODE_THRESHOLDS) + \
    ") AS t(mode, family, threshold_db, description)"
add_cte("thresholds", THRESHOLDS_VALUES, [])



def scored_sql(profile: str, advantage: str) -> str:
    return f"""
SELECT p.*, '{profile}' AS profile, predicted_snr - actual_snr AS snr_error,
       CAST(predicted_snr + {advantage} >= -20 AS INTEGER) AS ft8_viable, CAST(predicted_snr + {advantage} >= -10 AS INTEGER) AS cw_viable,
       CAST(predicted_snr + {advantage} >= -5 AS INTEGER) AS rtty_viable, CAST(predicted_snr + {advantage} >= 5 AS INTEGER) AS ssb_viable,
       CASE WHEN t.threshold_db IS NULL THEN NULL ELSE CAST(predicted_snr + {advantage} >= t.threshold_db AS INTEGER) END AS mode_hit
FROM sig_pred p LEFT JOIN thresholds t ON t.mode = CASE p.actual_mode WHEN 'PH' THEN 'SSB' WHEN 'RY' THEN 'RTTY'
                                                 ELSE p.actual_mode END"""


add_cte("scored", scored_sql("wspr", "0"), ["sig_pred", "thresholds"])
add_cte("scored_portable", scored_sql("portable", "10.0::DOUBLE * log10(5.0::DOUBLE / 0.2::DOUBLE)"), ["sig_pred", "thresholds"])

add_cte("qt_paths", f"""
SELECT CAST(coalesce(o.off, 0) + q.rn AS BIGINT) AS path_id, q.* FROM (
  SELECT *, row_number() OVER (PARTITION BY band ORDER BY h, tx_grid_4, rx_grid_4, hour, month) AS rn FROM (
    SELECT *, {hash_u32("concat_ws('|', 'quality-test', tx_grid_4, rx_grid_4, CAST(band AS VARCHAR), CAST(hour AS VARCHAR), CAST(month AS VARCHAR))")} AS h
    FROM sig_v1 WHERE spot_count > 8)
  QUALIFY rn <= 40) q
LEFT JOIN (SELECT band, sum(c) OVER (ORDER BY band ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS off FROM (
    SELECT band, least(count(*), 40) AS c FROM sig_v1 WHERE spot_count > 8 GROUP BY band)) o ON o.band = q.band""", ["sig_v1"])
