"""Deterministic, engine-portable hashing for sampling order.

The first 8 hex digits of an MD5 give a 32-bit unsigned value; the same bits
are reproducible in any SQL engine, so sampled sets can be checked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(*cols, seed: str | None = None) -> Column:
    parts = [_c(c).cast("string") for c in cols]
    if seed is not None:
        parts = [F.lit(seed)] + parts
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def hash_u32(*cols, seed: str | None = None) -> Column:
    return F.conv(F.substring(F.md5(hash_key(*cols, seed=seed)), 1, 8), 16, 10).cast("bigint")


def hash_u(*cols, seed: str | None = None) -> Column:
    """Uniform in [0, 1)."""
    return hash_u32(*cols, seed=seed) / F.lit(4294967296.0)
