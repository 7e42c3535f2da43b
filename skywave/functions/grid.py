"""Maidenhead locator expressions.

Characters 1, 3, 5, 7 carry longitude (field 20 deg, square 2 deg, subsquare
5', extended square 0.5'); characters 2, 4, 6, 8 carry latitude (10 deg, 1 deg,
2.5', 0.25').  A locator's point is the centre of its smallest cell.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skywave.constants import FIELD_PREFIX_PATTERN, LOCATOR_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_fixed(c) -> Column:
    """Strip the NUL padding of fixed-width strings."""
    return F.replace(_c(c), F.char(F.lit(0)), F.lit(""))


def grid4(c) -> Column:
    return F.substring(_c(c), 1, 4)


def grid6(c) -> Column:
    return F.substring(_c(c), 1, 6)


def has_valid_field(c) -> Column:
    """At least 4 characters and an upper-case field + square prefix."""
    c = _c(c)
    return (F.length(c) >= 4) & c.rlike(FIELD_PREFIX_PATTERN)


def is_valid_locator(c) -> Column:
    """Full 4/6/8-character locator format (either case)."""
    return _c(c).rlike(LOCATOR_PATTERN)


def _code(c: Column, pos: int, case: str | None = None) -> Column:
    ch = F.substring(c, pos, 1)
    if case == "upper":
        ch = F.upper(ch)
    elif case == "lower":
        ch = F.lower(ch)
    return F.ascii(ch).cast("double")


def maidenhead_lon(c, precision: int = 4) -> Column:
    """Longitude of the cell centre; ``precision`` 4 uses only field+square,
    6 and 8 refine with the subsquare / extended square when present."""
    c = _c(c)
    base = (_code(c, 1, "upper") - 65) * 20 + (_code(c, 3) - 48) * 2 - 180
    if precision <= 4:
        return base + 1.0
    sub = base + (_code(c, 5, "lower") - 97) * (5.0 / 60)
    six = F.when(F.length(c) >= 6, sub + 2.5 / 60).otherwise(base + 1.0)
    if precision <= 6:
        return six
    ext = sub + (_code(c, 7) - 48) * (0.5 / 60) + 0.25 / 60
    return F.when(F.length(c) >= 8, ext).otherwise(six)


def maidenhead_lat(c, precision: int = 4) -> Column:
    c = _c(c)
    base = (_code(c, 2, "upper") - 65) * 10 + (_code(c, 4) - 48) - 90
    if precision <= 4:
        return base + 0.5
    sub = base + (_code(c, 6, "lower") - 97) * (2.5 / 60)
    six = F.when(F.length(c) >= 6, sub + 1.25 / 60).otherwise(base + 0.5)
    if precision <= 6:
        return six
    ext = sub + (_code(c, 8) - 48) * (0.25 / 60) + 0.125 / 60
    return F.when(F.length(c) >= 8, ext).otherwise(six)


def maidenhead_point(c, precision: int = 8) -> Column:
    """struct<lat: double, lon: double> of the locator's centre (NULL if < 4 chars)."""
    c = _c(c)
    return F.when(F.length(c) >= 4, F.struct(maidenhead_lat(c, precision).alias("lat"),
                                             maidenhead_lon(c, precision).alias("lon")))


def midpoint_lat_expr(tx, rx) -> Column:
    """Mid-latitude of two 4-char grid centres from the raw character codes
    (no case folding, as the gold builds compute it)."""
    tx, rx = _c(tx), _c(rx)
    a = (_code(tx, 2) - 65) * 10 + (_code(tx, 4) - 48)
    b = (_code(rx, 2) - 65) * 10 + (_code(rx, 4) - 48)
    return (a + b) / 2.0 - 90 + 0.5
