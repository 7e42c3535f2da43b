"""Domain parameters.

Fixed values that must equal the reference's for the same results are listed
together here, in natural order, as plain text.  Everything else takes them as
parameters with these as defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------

# ADIF band ids of the ten HF bands and their names.
HF_BANDS = [102, 103, 104, 105, 106, 107, 108, 109, 110, 111]
HF_BAND_NAMES = ["160m", "80m", "60m", "40m", "30m", "20m", "17m", "15m", "12m", "10m"]

# Band centre frequency in MHz (for prediction inputs); default for other ids.
BAND_CENTRE_MHZ = {102: 1.84, 103: 3.57, 104: 5.29, 105: 7.04, 106: 10.14,
                   107: 14.10, 108: 18.10, 109: 21.10, 110: 24.92, 111: 28.13}
DEFAULT_CENTRE_MHZ = 14.10

# SSN quintile cut points (right-closed bins 1..5).
SSN_QUINTILE_CUTS = [46.0, 76.0, 124.0, 153.0]

# Signature builds.
MIN_DISTANCE_KM = 500
WSPR_MIN_SPOTS = 5
CONTEST_MIN_SPOTS = 3
RBN_MIN_SPOTS = 3
RELIABLE_SNR_DB = -20          # reliability = share of spots with snr > this
RBN_SNR_RANGE = (-20, 80)
RBN_MODES = ["CW", "RTTY", "PSK31", ""]
CONTEST_MODES = ["PH", "RY"]
CONTEST_ANCHOR_SNR = {"PH": 10.0, "RY": 0.0}

# Windows (half-open on timestamps).
CONTEST_WINDOW = ("2005-01-01", "2026-01-01")
RBN_WINDOW = ("2009-01-01", "2026-01-01")
GOLD_WINDOW = ("2020-01-01", "2026-02-04")
GOLD_SNR_RANGE = (-35, 25)
GOLD_DISTANCE_RANGE = (500, 18000)

# Balloon / telemetry flags.
VELOCITY_GRIDS_PER_DAY = 45
EPOCH_FLAG_DATE = "1970-01-01"
# Mobility tiers by distinct 4-char grids per day: fixed 1, maritime < 10,
# ground vehicle < 25, fast mover >= 45 (25..44 stays unclassified).
MOBILITY_TIERS = [("Fixed", 1), ("Maritime", 10), ("Vehicle", 25), ("Fast", 45)]

# Gold samples.
STRATIFIED_PER_CELL = 200_000
CONTINUOUS_PER_BAND = 1_000_000
DENSITY_SAMPLE_BAND = 107
DENSITY_SAMPLE_LIMIT = 10_000_000
DENSITY_SSN_BIN_WIDTH = 20
DENSITY_LAT_BIN_WIDTH = 10
DENSITY_FLOOR = 50
QUALITY_TEST_PER_BAND = 10_000
QUALITY_TEST_MIN_SPOTS = 50     # strictly greater than

# SSN from SFI (Covington): greatest(0, (sfi - 63.7) / 0.727).
SFI_OFFSET = 63.7
SFI_SCALE = 0.727

# Pipeline gates.
MIN_CALLSIGN_GRID_ROWS = 3_000_000
MIN_FLAG_ROWS = 100

# Mode decode thresholds (mode, family, threshold_db, description).
MODE_THRESHOLDS = [
    ("FT8", "digital", -20.0, "WSJT-X FT8 decode threshold"),
    ("FT4", "digital", -20.0, "WSJT-X FT4 decode threshold"),
    ("JS8", "digital", -20.0, "JS8Call decode threshold"),
    ("JT65", "digital", -20.0, "WSJT legacy JT65"),
    ("JT9", "digital", -20.0, "WSJT legacy JT9"),
    ("FST4", "digital", -20.0, "WSJT-X slow mode"),
    ("Q65", "digital", -20.0, "WSJT-X weak signal / EME"),
    ("PSK31", "digital", -20.0, "Narrow-band PSK"),
    ("OLIVIA", "digital", -20.0, "MFSK with FEC"),
    ("WSPR", "digital", -28.0, "WSPR beacon decode floor"),
    ("CW", "cw", -10.0, "Human / skimmer CW decode"),
    ("RTTY", "rtty", -5.0, "RTTY ~300 Hz bandwidth"),
    ("SSB", "phone", 5.0, "Voice SSB ~2.4 kHz bandwidth"),
    ("AM", "phone", 5.0, "Voice AM wider bandwidth"),
    ("FM", "phone", 5.0, "Voice FM (VHF primarily)"),
]
# Viability flags of the four threshold families.
FAMILY_FLAGS = [("ft8_viable", -20.0), ("cw_viable", -10.0), ("rtty_viable", -5.0), ("ssb_viable", 5.0)]
# Contest log modes -> ADIF modes for the threshold lookup.
CONTEST_MODE_TO_ADIF = {"PH": "SSB", "RY": "RTTY", "CW": "CW", "FM": "FM"}
# Reference transmit power of the baseline station profile (W).
WSPR_REFERENCE_POWER_W = 0.2

# Maidenhead locator formats.
LOCATOR_PATTERN = r"^[A-Ra-r]{2}[0-9]{2}([A-Xa-x]{2})?([0-9]{2})?$"
FIELD_PREFIX_PATTERN = r"^[A-R]{2}[0-9]{2}"
RESERVED_PREFIX_PATTERNS = [r"^Q", r"^[0-9]{2}"]

# Bronze schema contract: 17 columns, v2 rows carry column_count = 17, rows
# upgraded from v1 get mode 'WSPR' and column_count 15.
BRONZE_V2_COLUMNS = 17
V1_DEFAULT_MODE = "WSPR"
V1_DEFAULT_COLUMN_COUNT = 15

EARTH_RADIUS_KM = 6371.0

# ---------------------------------------------------------------------------
# Parameters the reference leaves unspecified (our choices, documented)
# ---------------------------------------------------------------------------

# Kp cut-offs for the live conditions label (lower bounds).
KP_CONDITION_CUTS = [("Quiet", 0.0), ("Unsettled", 4.0), ("Storm", 5.0), ("Severe Storm", 7.0)]
# X-ray long-channel flux at or above which "+ Radio Blackout" is appended (M1).
XRAY_BLACKOUT_W_M2 = 1e-5
