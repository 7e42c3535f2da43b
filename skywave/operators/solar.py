"""Solar indices: latest readings, daily view, 3-hour buckets and the spot joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.functions.solar import solar_bucket
from skywave.operators.tables import latest_by_key

INDEX_COLUMNS = ["observed_flux", "adjusted_flux", "ssn", "kp_index", "ap_index", "xray_short", "xray_long"]


def solar_latest(solar: DataFrame) -> DataFrame:
    """One row per (date, time): the newest ``updated_at`` wins."""
    return latest_by_key(solar, ["date", "time"], ["updated_at"])


def solar_daily(solar: DataFrame) -> DataFrame:
    """Daily view: max of each index over the day's latest readings and any
    source file (the smallest name, to be deterministic), newest day first."""
    latest = solar_latest(solar)
    return (latest.groupBy("date")
            .agg(F.max("observed_flux").alias("sfi"), F.max("ssn").alias("ssn"), F.max("kp_index").alias("kp"),
                 F.max("ap_index").alias("ap"), F.max("xray_short").alias("xray_short"),
                 F.max("xray_long").alias("xray_long"), F.min("source_file").alias("primary_source"))
            .orderBy(F.col("date").desc()))


def solar_buckets(solar: DataFrame, how: str = "max") -> DataFrame:
    """One row per (date, 3-hour bucket) over the latest readings:
    ssn, sfi (observed flux) and kp aggregated with ``how`` (max or avg)."""
    agg = {"max": F.max, "avg": F.avg}[how]
    latest = solar_latest(solar)
    return (latest.groupBy("date", solar_bucket("time").alias("bucket"))
            .agg(agg("ssn").alias("ssn"), agg("observed_flux").alias("sfi"), agg("kp_index").alias("kp")))


def _spot_keys(spots: DataFrame, ts_col: str) -> DataFrame:
    return spots.withColumn("__d", F.to_date(F.col(ts_col))).withColumn("__b", solar_bucket(F.col(ts_col)))


def join_solar_raw(spots: DataFrame, solar: DataFrame, ts_col: str = "timestamp", zero_fill: bool = True) -> DataFrame:
    """Left join of spots to every latest solar reading of the spot's (date,
    3-hour bucket); several readings in a bucket fan the spot out, exactly like
    the reference's signature join.  Unmatched spots get 0.0 (``zero_fill``)
    or NULL."""
    sol = solar_latest(solar).select(
        F.col("date").alias("__sd"), solar_bucket("time").alias("__sb"),
        F.col("observed_flux").alias("sfi"), F.col("kp_index").alias("kp"), F.col("ssn").alias("ssn"))
    j = _spot_keys(spots, ts_col).join(sol, (F.col("__d") == F.col("__sd")) & (F.col("__b") == F.col("__sb")), "left")
    j = j.drop("__d", "__b", "__sd", "__sb")
    if zero_fill:
        j = j.fillna(0.0, subset=["sfi", "kp", "ssn"])
    return j


def join_solar_bucketed(spots: DataFrame, solar: DataFrame, ts_col: str = "timestamp", how: str = "inner",
                        agg: str = "max", zero_fill: bool = True) -> DataFrame:
    """Join spots to the one-row-per-bucket table (gold builds use ``inner``
    with max; signatures use ``left`` with the bucket average)."""
    b = solar_buckets(solar, agg).withColumnRenamed("date", "__sd").withColumnRenamed("bucket", "__sb")
    # at most 8 rows per calendar day: 200 years of days are 585,600 rows of 40 bytes
    b = F.broadcast(b)
    j = _spot_keys(spots, ts_col).join(b, (F.col("__d") == F.col("__sd")) & (F.col("__b") == F.col("__sb")), how)
    j = j.drop("__d", "__b", "__sd", "__sb")
    if how == "left" and zero_fill:
        j = j.fillna(0.0, subset=["sfi", "kp", "ssn"])
    return j


def attach_solar(spots: DataFrame, solar: DataFrame, mode: str = "bucketed", ts_col: str = "timestamp",
                 zero_fill: bool = True) -> DataFrame:
    """Solar attachment used by the signature builds.

    ``bucketed`` (default): left join to the per-bucket average of the latest
    readings, so a spot is counted once.  ``raw``: the reference's literal join
    to every reading (a bucket with two readings doubles its spots)."""
    if mode == "raw":
        return join_solar_raw(spots, solar, ts_col, zero_fill)
    return join_solar_bucketed(spots, solar, ts_col, how="left", agg="avg", zero_fill=zero_fill)


def solar_coverage_start(solar: DataFrame) -> DataFrame:
    """First date with flux > 0 (a warning is due when signatures start earlier)."""
    return solar.where(F.col("observed_flux") > 0).agg(
        F.min("date").alias("first_flux_date"), F.max("date").alias("last_flux_date"),
        F.countDistinct("date").alias("days_with_flux"))
