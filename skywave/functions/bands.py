"""Band ids, centre frequencies and frequency -> band resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skywave.constants import BAND_CENTRE_MHZ, DEFAULT_CENTRE_MHZ

# HF amateur allocations (IARU, MHz) keyed by the ADIF-style band id used
# throughout.  The reference resolves bands in an external helper, so the edge
# table is a parameter; this is the default.
DEFAULT_BAND_EDGES_MHZ = [
    (102, 1.800, 2.000), (103, 3.500, 4.000), (104, 5.060, 5.450), (105, 7.000, 7.300),
    (106, 10.100, 10.150), (107, 14.000, 14.350), (108, 18.068, 18.168), (109, 21.000, 21.450),
    (110, 24.890, 24.990), (111, 28.000, 29.700),
]

_UNIT_TO_MHZ = {"hz": 1e-6, "khz": 1e-3, "mhz": 1.0}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_freq_mhz(band) -> Column:
    band = _c(band)
    expr = None
    for b, mhz in BAND_CENTRE_MHZ.items():
        expr = F.when(band == b, mhz) if expr is None else expr.when(band == b, mhz)
    return expr.otherwise(DEFAULT_CENTRE_MHZ)


def freq_to_band(freq, unit: str = "hz", edges=DEFAULT_BAND_EDGES_MHZ) -> Column:
    """Band id of a frequency (closed band edges); 0 outside every band.

    The edge table is small and fixed, so a CASE chain keeps the lookup inside
    whole-stage codegen; ``band_edges_df`` gives the same table for joins."""
    mhz = _c(freq).cast("double") * _UNIT_TO_MHZ[unit.lower()]
    expr = None
    for band, lo, hi in edges:
        cond = (mhz >= lo) & (mhz <= hi)
        expr = F.when(cond, band) if expr is None else expr.when(cond, band)
    return expr.otherwise(0)


def band_edges_df(spark: SparkSession, edges=DEFAULT_BAND_EDGES_MHZ) -> DataFrame:
    schema = T.StructType([T.StructField("band", T.IntegerType(), False),
                           T.StructField("lo_mhz", T.DoubleType(), False),
                           T.StructField("hi_mhz", T.DoubleType(), False)])
    return spark.createDataFrame(edges, schema)
