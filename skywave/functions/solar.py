"""Solar-index expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skywave.constants import KP_CONDITION_CUTS, SFI_OFFSET, SFI_SCALE, SSN_QUINTILE_CUTS, XRAY_BLACKOUT_W_M2


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def solar_bucket(ts) -> Column:
    """3-hour bucket of the UTC day (0..7)."""
    return F.floor(F.hour(_c(ts)) / 3).cast("int")


def ssn_quintile(ssn, cuts=SSN_QUINTILE_CUTS) -> Column:
    """Right-closed bins: <= c1 -> 1, <= c2 -> 2, ..., > c4 -> 5."""
    ssn = _c(ssn)
    expr = None
    for i, cut in enumerate(cuts, start=1):
        expr = F.when(ssn <= cut, i) if expr is None else expr.when(ssn <= cut, i)
    return expr.otherwise(len(cuts) + 1)


def ssn_from_sfi(sfi) -> Column:
    return F.greatest(F.lit(0.0), (_c(sfi).cast("double") - SFI_OFFSET) / SFI_SCALE)


def kp_penalty(kp) -> Column:
    """1 - kp/9: 1.0 at Kp 0, 0.0 at Kp 9."""
    return F.lit(1.0) - _c(kp).cast("double") / 9.0


def conditions_label(kp, xray_long=None, kp_cuts=KP_CONDITION_CUTS, blackout=XRAY_BLACKOUT_W_M2) -> Column:
    kp = _c(kp)
    expr = None
    for label, lower in reversed(kp_cuts):
        expr = F.when(kp >= lower, label) if expr is None else expr.when(kp >= lower, label)
    label = expr.otherwise(kp_cuts[0][0])
    if xray_long is None:
        return label
    return F.when(_c(xray_long) >= blackout, F.concat(label, F.lit(" + Radio Blackout"))).otherwise(label)
