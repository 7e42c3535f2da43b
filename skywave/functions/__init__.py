"""Column functions (all Catalyst expressions; no Python UDFs)."""

from skywave.functions.grid import (  # noqa: F401
    clean_fixed, grid4, grid6, has_valid_field, is_valid_locator,
    maidenhead_lat, maidenhead_lon, maidenhead_point,
)
from skywave.functions.geo import azimuth_deg, great_circle_km, midpoint_lat  # noqa: F401
from skywave.functions.solar import (  # noqa: F401
    conditions_label, kp_penalty, solar_bucket, ssn_from_sfi, ssn_quintile,
)
from skywave.functions.bands import band_freq_mhz, band_edges_df, freq_to_band  # noqa: F401
from skywave.functions.hashing import hash_u, hash_key  # noqa: F401
