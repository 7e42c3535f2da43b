"""Monitoring views: integrity counters, daily summaries, versions and config."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.constants import BRONZE_V2_COLUMNS
from skywave.operators.tables import latest_by_key


def data_integrity(spots: DataFrame) -> DataFrame:
    """One row of counters over the bronze table, in a single pass."""
    return spots.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("frequency") == 0).alias("zero_frequency"),
        F.count_if(F.unix_seconds("timestamp") == 0).alias("zero_timestamp"),
        F.count_if(F.col("callsign") == "").alias("empty_callsign"),
        F.count_if(F.col("reporter") == "").alias("empty_reporter"),
        F.count_if(F.col("column_count") != BRONZE_V2_COLUMNS).alias("non_v2_rows"),
        F.min("timestamp").alias("earliest_spot"),
        F.max("timestamp").alias("latest_spot"))


def spots_daily(spots: DataFrame, exact: bool = True) -> DataFrame:
    """day x band x mode: spots, distinct transmitters and receivers, mean SNR,
    longest path.  ``exact=False`` uses HyperLogLog distinct counts (one
    aggregation level)."""
    distinct = F.countDistinct if exact else F.approx_count_distinct
    return (spots.groupBy(F.to_date("timestamp").alias("day"), "band", "mode")
            .agg(F.count(F.lit(1)).alias("spot_count"), distinct("callsign").alias("unique_tx"),
                 distinct("reporter").alias("unique_rx"), F.avg("snr").alias("avg_snr"),
                 F.max("distance").alias("max_distance")))


def latest_versions(versions: DataFrame) -> DataFrame:
    """Per component: version and installer of the newest install, and its time."""
    return (versions.groupBy("component")
            .agg(F.max_by("version", "installed_at").alias("version"),
                 F.max("installed_at").alias("latest_installed_at"),
                 F.max_by("installed_by", "installed_at").alias("installed_by"))
            .orderBy("component"))


def recent_versions(versions: DataFrame, n: int = 10) -> DataFrame:
    """The n most recent installs (a top-n report)."""
    return versions.select("component", "version", "installed_at").orderBy(
        F.col("installed_at").desc(), "component", "version").limit(n)


def latest_config(config: DataFrame) -> DataFrame:
    return latest_by_key(config, ["key"], ["updated_at"]).select("key", "value", "updated_at")


def pending_files(listing: DataFrame, log: DataFrame, reload_primed: bool = False, reload_grown: bool = False) -> DataFrame:
    """Files in ``listing`` that have never been logged.  An entry of 0 rows
    (primed at bootstrap, or an empty file) counts as loaded, too;
    ``reload_primed`` loads those again, ``reload_grown`` those whose size has
    changed since their latest entry."""
    latest = latest_by_key(log, ["file_path"], ["loaded_at"]).select(
        F.col("file_path").alias("__p"), F.col("file_size").alias("__s"), F.col("row_count").alias("__r"))
    done = latest.where(F.col("__r") > 0) if reload_primed else latest
    same = F.col("file_path") == F.col("__p")
    if reload_grown:
        same = same & (F.col("file_size") == F.col("__s"))
    return listing.join(done, same, "left_anti").select("file_path", "file_size")


def ingest_log_latest(log: DataFrame) -> DataFrame:
    return latest_by_key(log, ["file_path"], ["loaded_at"])
