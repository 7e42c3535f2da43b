"""Query registry: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}

DIGITS = 4
EXACT = frozenset({"xray_short", "xray_long", "xray_flux"})


def finalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Comparison step of queries that sum: engines add in different orders, so
    their floating-point columns are reported as double rounded to ``digits``
    decimals.  Columns in EXACT hold values as they were read (flux in W/m^2 is
    far below any fixed number of decimals) and pass through; the operators
    themselves never round."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in EXACT:
            # 9 decimals first: sums taken in different orders differ in the
            # last ulp, which must not decide a half-way case at ``digits``.
            cols.append(F.round(F.round(F.col(f.name).cast("double"), 9), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, rounded: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from skywave.session import ensure_utc
            ensure_utc(spark)
            out = fn(spark, sf_dir)
            return finalize(out) if rounded else out

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    from skywave.plans import catalog  # noqa: F401  (registers on import)
    return dict(_QUERIES)
