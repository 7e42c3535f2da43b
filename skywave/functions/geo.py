"""Path geometry on a spherical Earth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skywave.constants import EARTH_RADIUS_KM


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def great_circle_km(lon1, lat1, lon2, lat2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km."""
    lon1, lat1, lon2, lat2 = map(_c, (lon1, lat1, lon2, lat2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def azimuth_deg(lon1, lat1, lon2, lat2) -> Column:
    """Initial bearing from point 1 to point 2, degrees in [0, 360)."""
    lon1, lat1, lon2, lat2 = map(_c, (lon1, lat1, lon2, lat2))
    dlon = F.radians(lon2 - lon1)
    y = F.sin(dlon) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def midpoint_lat(lat1, lat2) -> Column:
    """Arithmetic mid-latitude of a path (the reference's density axis)."""
    return (_c(lat1) + _c(lat2)) / 2.0
