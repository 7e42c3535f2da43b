"""Signatures and callsign dimension kept up to date without rescanning spots.

Both are functions of sums that can be merged.  What a set of spots adds is stored
as partials per calendar part (a month, or a day); a new or replayed part is
written over its own partials, from its own spots alone, and results are derived
from the partials.

*Signatures.*  Per (signature key, SNR): spots and the sums of the solar and path
values.  The rows of a key are its SNR histogram, from which the exact median, the
spread and the reliability follow.  A key holds its calendar month, so partials
are partitioned by it, and a refresh after a new month reads a twelfth of them.

*Callsigns.*  The station-days of ``callsigns.station_days``, a folder for each load:
``callsign_grid(summary=station_days_of(spark, path))`` decides over each day's newest
load, and so do the flags that derive from station-days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave import constants as K
from skywave.functions.grid import grid4
from skywave.operators.signatures import KEYS, SIGNATURE_COLUMNS
from skywave.operators.solar import attach_solar

_SUMS = ["n", "sum_sfi", "sum_kp", "sum_distance", "sum_azimuth"]


def signature_partials(spots: DataFrame, solar: DataFrame | None, bands=K.HF_BANDS, min_distance: int = K.MIN_DISTANCE_KM,
                       solar_mode: str = "bucketed") -> DataFrame:
    """What spots add to signatures: a row per key, SNR and month of the calendar (ym)."""
    s = spots.select("timestamp", "grid", "reporter_grid", "band", "snr", "distance", "azimuth")
    s = s.where((F.col("distance") >= min_distance) & F.col("band").isin(list(bands)))
    s = attach_solar(s, solar, solar_mode) if solar is not None else s.withColumn("sfi", F.lit(0.0)).withColumn("kp", F.lit(0.0))
    return (s.groupBy(grid4("grid").alias("tx_grid_4"), grid4("reporter_grid").alias("rx_grid_4"), "band", F.hour("timestamp").alias("hour"),
                      F.month("timestamp").alias("month"), F.date_format("timestamp", "yyyyMM").cast("int").alias("ym"), "snr")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("sfi").alias("sum_sfi"), F.sum("kp").alias("sum_kp"),
                  F.sum("distance").alias("sum_distance"), F.sum("azimuth").alias("sum_azimuth")))


def add_months(spots: DataFrame, solar: DataFrame | None, partials_path: str, **kw) -> None:
    """Writes the partials of the months that spots holds over what is stored of
    them; spots must hold those months whole."""
    (signature_partials(spots, solar, **kw).hint("rebalance", "month", "ym").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("month", "ym").parquet(partials_path))


def signatures_of(partials: DataFrame, min_spots: int = K.WSPR_MIN_SPOTS, reliable_above: float = K.RELIABLE_SNR_DB) -> DataFrame:
    """Signatures of all spots whose partials these are: those of ``wspr_signatures``."""
    n, x, dec = F.col("n"), F.col("snr").cast("bigint"), "decimal(38,0)"
    count, total, squares = F.sum("n"), F.sum(n * x), F.sum(n * x * x)
    spread = count.cast(dec) * squares.cast(dec) - total.cast(dec) * total.cast(dec)
    out = partials.groupBy(*KEYS).agg(
        F.percentile("snr", 0.5, n).alias("median_snr"), count.alias("spot_count"),
        (F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0))) / count).alias("snr_std"),
        (F.sum(F.when(F.col("snr") > reliable_above, n).otherwise(F.lit(0))) / count).alias("reliability"),
        (F.sum("sum_sfi") / count).alias("avg_sfi"), (F.sum("sum_kp") / count).alias("avg_kp"),
        (F.sum("sum_distance") / count).cast("bigint").alias("avg_distance"), (F.sum("sum_azimuth") / count).cast("bigint").alias("avg_azimuth"))
    return out.where(F.col("spot_count") >= min_spots).select(*SIGNATURE_COLUMNS)


def refresh_signatures(spark: SparkSession, partials_path: str, signatures_path: str, months: Sequence[int] | None = None, **kw) -> None:
    """Derives the signatures of calendar ``months`` (all by default) anew and writes
    them over their partitions; only those months' partials are read."""
    rows = spark.read.parquet(partials_path)
    if months is not None:
        rows = rows.where(F.col("month").isin(list(months)))
    (signatures_of(rows, **kw).hint("rebalance", "month").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(signatures_path))


def add_days(spots: DataFrame, path: str, load: int) -> None:
    """Stores the station-days of spots, whole days, as load number ``load``; they
    replace what earlier loads stored of these days.  Repeating a load replaces it."""
    from skywave.operators.callsigns import station_days
    station_days(spots).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/load={load}")


def station_days_of(spark: SparkSession, path: str) -> DataFrame:
    """The stored station-days, each day's from its newest load: as
    ``callsigns.station_days`` of all spots."""
    rows = spark.read.parquet(path)
    newest = rows.groupBy("d").agg(F.max("load").alias("__load")).withColumnRenamed("d", "__d")   # a row for each day
    return rows.join(newest, F.col("d").eqNullSafe(F.col("__d")) & (F.col("load") == F.col("__load")), "left_semi").drop("load")
