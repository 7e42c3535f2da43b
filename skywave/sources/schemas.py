"""Explicit schemas of every dataset (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, F32 = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.FloatType()
TS, DT = T.TimestampType(), T.DateType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Bronze WSPR spot, 17 columns in contract order.
WSPR_SPOT = _schema(
    ("id", L), ("timestamp", TS), ("reporter", S), ("reporter_grid", S), ("snr", I),
    ("frequency", L), ("callsign", S), ("grid", S), ("power", I), ("drift", I),
    ("distance", L), ("azimuth", I), ("band", I), ("mode", S), ("version", S),
    ("code", I), ("column_count", I),
)

# Contract: reference type, max width for fixed strings, integer range.
WSPR_CONTRACT = [
    ("id", "UInt64", None, (0, None)),
    ("timestamp", "DateTime", None, None),
    ("reporter", "FixedString(16)", 16, None),
    ("reporter_grid", "FixedString(8)", 8, None),
    ("snr", "Int8", None, (-128, 127)),
    ("frequency", "UInt64", None, (0, None)),
    ("callsign", "FixedString(16)", 16, None),
    ("grid", "FixedString(8)", 8, None),
    ("power", "Int8", None, (-128, 127)),
    ("drift", "Int8", None, (-128, 127)),
    ("distance", "UInt32", None, (0, 4294967295)),
    ("azimuth", "UInt16", None, (0, 65535)),
    ("band", "Int32", None, None),
    ("mode", "FixedString(8)", 8, None),
    ("version", "FixedString(8)", 8, None),
    ("code", "UInt8", None, (0, 255)),
    ("column_count", "UInt8", None, (0, 255)),
]

SOLAR = _schema(
    ("date", DT), ("time", TS), ("observed_flux", D), ("adjusted_flux", D), ("ssn", D),
    ("kp_index", D), ("ap_index", D), ("xray_short", D), ("xray_long", D),
    ("source_file", S), ("updated_at", TS),
)

RBN_SPOT = _schema(
    ("timestamp", TS), ("de_call", S), ("de_pfx", S), ("de_cont", S), ("frequency", L),
    ("band", I), ("dx_call", S), ("dx_pfx", S), ("dx_cont", S), ("spot_type", S),
    ("snr", I), ("speed", I), ("tx_mode", S),
)

CONTEST_QSO = _schema(
    ("timestamp", TS), ("frequency", L), ("band", I), ("mode", S), ("call_1", S), ("call_2", S),
    ("rst_sent", S), ("exch_sent", S), ("rst_rcvd", S), ("exch_rcvd", S), ("contest", S), ("source", S),
)

PSKR_SPOT = _schema(
    ("timestamp", TS), ("sender_call", S), ("sender_grid", S), ("receiver_call", S),
    ("receiver_grid", S), ("frequency", L), ("band", I), ("mode", S), ("snr", I),
)

CALLSIGN_GRID = _schema(("callsign", S), ("grid", S), ("grid_4", S), ("spot_count", L), ("last_seen", DT))

FLAGS_V2 = _schema(("callsign", S), ("flag_reason", S), ("flag_date", DT), ("daily_grids", L), ("total_spots", L))

SIGNATURE = _schema(
    ("tx_grid_4", S), ("rx_grid_4", S), ("band", I), ("hour", I), ("month", I),
    ("median_snr", D), ("spot_count", L), ("snr_std", D), ("reliability", D),
    ("avg_sfi", D), ("avg_kp", D), ("avg_distance", L), ("avg_azimuth", L),
)
SIGNATURE_COLUMNS = [f.name for f in SIGNATURE.fields]

SILVER = _schema(
    ("timestamp", TS), ("tx_grid", S), ("rx_grid", S), ("frequency", L), ("band", I),
    ("distance", L), ("kp_index", D), ("xray_flux", D),
    ("embedding", T.ArrayType(F32)), ("computed_at", TS),
)

CATALOG = _schema(("callsign", S), ("entity", S), ("grid", S), ("year", I), ("qsos", L),
                  ("start_ts", TS), ("end_ts", TS))

MODE_THRESHOLDS = _schema(("mode", S), ("family", S), ("threshold_db", D), ("description", S))

INGEST_LOG = _schema(("file_path", S), ("file_size", L), ("row_count", L), ("loaded_at", TS),
                     ("elapsed_ms", L), ("hostname", S))

CONFIG = _schema(("key", S), ("value", S), ("updated_at", TS))
LAB_VERSIONS = _schema(("component", S), ("version", S), ("installed_at", TS), ("installed_by", S), ("notes", S))

LIVE_CONDITIONS = _schema(("kp_index", D), ("ap_index", D), ("solar_flux", D), ("xray_short", D),
                          ("xray_long", D), ("conditions", S))

MODEL_RESULT = _schema(
    ("run_id", S), ("run_timestamp", TS), ("model_version", S), ("source", S), ("profile", S),
    ("tx_grid_4", S), ("rx_grid_4", S), ("band", I), ("hour", I), ("month", I),
    ("distance_km", L), ("azimuth", L), ("actual_snr", D), ("actual_mode", S),
    ("predicted_snr", D), ("snr_error", D), ("ft8_viable", I), ("cw_viable", I),
    ("rtty_viable", I), ("ssb_viable", I), ("mode_hit", I), ("avg_sfi", D), ("avg_kp", D),
)

STEP_I_PATHS = _schema(
    ("tx_lat", D), ("tx_lon", D), ("rx_lat", D), ("rx_lon", D), ("freq_mhz", D), ("year", I),
    ("month", I), ("hour_utc", I), ("ssn", D), ("mode", S), ("model_snr", D), ("threshold", D),
    ("band_open", I),
)

# Row counts of each dataset's columns, used by table inventory checks.
EXPECTED_COLUMN_COUNTS = {
    "wspr.bronze": 17, "solar.bronze": 11, "rbn.bronze": 13, "contest.bronze": 12,
    "pskr.bronze": 9, "wspr.callsign_grid": 5, "wspr.balloon_callsigns_v2": 5,
    "wspr.signatures_v1": 13,
}
