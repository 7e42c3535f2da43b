"""Model inputs derived from signatures and live solar state."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywave.functions.bands import band_freq_mhz
from skywave.functions.grid import maidenhead_lat, maidenhead_lon
from skywave.functions.solar import conditions_label, kp_penalty, solar_bucket
from skywave.operators.tables import latest_by_key

TWO_PI = 2.0 * math.pi


def signature_features(sig: DataFrame) -> DataFrame:
    """The 13 model features of a signature: distance, freq_log, hour sin/cos,
    azimuth sin/cos, lat_diff, midpoint_lat, season sin/cos, day_night_est,
    sfi (avg_sfi/300) and kp_penalty (1 - avg_kp/9).

    day_night_est (its formula is not given by the source) is the cosine of the
    local solar hour at the path midpoint: +1 at local noon, -1 at midnight."""
    tlat, tlon = maidenhead_lat("tx_grid_4"), maidenhead_lon("tx_grid_4")
    rlat, rlon = maidenhead_lat("rx_grid_4"), maidenhead_lon("rx_grid_4")
    mid_lon = (tlon + rlon) / 2.0
    local_hour = F.col("hour") + mid_lon / 15.0
    return sig.select(
        "tx_grid_4", "rx_grid_4", "band", "hour", "month",
        F.col("avg_distance").cast("double").alias("distance"),
        F.log10(band_freq_mhz("band")).alias("freq_log"),
        F.sin(F.col("hour") * (TWO_PI / 24)).alias("hour_sin"),
        F.cos(F.col("hour") * (TWO_PI / 24)).alias("hour_cos"),
        F.sin(F.radians("avg_azimuth")).alias("az_sin"),
        F.cos(F.radians("avg_azimuth")).alias("az_cos"),
        (rlat - tlat).alias("lat_diff"),
        ((tlat + rlat) / 2.0).alias("midpoint_lat"),
        F.sin(F.col("month") * (TWO_PI / 12)).alias("season_sin"),
        F.cos(F.col("month") * (TWO_PI / 12)).alias("season_cos"),
        F.cos((local_hour - 12.0) * (TWO_PI / 24)).alias("day_night_est"),
        (F.col("avg_sfi") / 300.0).alias("sfi"),
        kp_penalty("avg_kp").alias("kp_penalty"),
        F.col("median_snr").alias("target_snr"),
    )


def conditions_by_bucket(solar: DataFrame) -> DataFrame:
    """Per (date, 3-hour bucket): the newest reading's indices and its label."""
    r = solar.withColumn("bucket", solar_bucket("time"))
    latest = latest_by_key(r, ["date", "bucket"], ["time", "updated_at"])
    return latest.select("date", "bucket", "kp_index", "ap_index", F.col("observed_flux").alias("solar_flux"),
                         "xray_short", "xray_long", conditions_label("kp_index", "xray_long").alias("conditions"))


def live_conditions(solar: DataFrame) -> DataFrame:
    """Current state: the newest reading (a top-1, merged from per-task tops)."""
    newest = solar.orderBy(F.col("time").desc(), F.col("updated_at").desc()).limit(1)
    return newest.select("kp_index", "ap_index", F.col("observed_flux").alias("solar_flux"), "xray_short", "xray_long",
                         conditions_label("kp_index", "xray_long").alias("conditions"))


def enrich_with_conditions(spots: DataFrame, conditions: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Match spots to the conditions of their (date, 3-hour bucket); usable as a
    stream-static join with a streaming ``spots``."""
    # at most 8 rows per calendar day: 200 years of days are 585,600 rows
    c = F.broadcast(conditions.withColumnRenamed("date", "__cd").withColumnRenamed("bucket", "__cb"))
    j = spots.join(c, (F.to_date(F.col(ts_col)) == F.col("__cd")) & (solar_bucket(F.col(ts_col)) == F.col("__cb")), "left")
    return j.drop("__cd", "__cb")


def quality_distribution(silver: DataFrame, score_index: int = 4) -> DataFrame:
    """Hour x band x 0.1-wide score bucket: count and the sums behind the
    averages (sums and counts merge across increments; averages do not)."""
    return (with_quality_bucket(silver, score_index)
            .groupBy(F.date_trunc("hour", "timestamp").alias("hour_start"), "band", "quality_bucket")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("distance").alias("sum_distance"),
                 F.sum("kp_index").alias("sum_kp"))
            .withColumn("avg_distance", F.col("sum_distance") / F.col("count"))
            .withColumn("avg_kp", F.col("sum_kp") / F.col("count")))


def with_quality_bucket(silver: DataFrame, score_index: int = 4) -> DataFrame:
    """score = embedding element ``score_index`` (1-based; 0 when absent), as
    double before flooring."""
    score = F.coalesce(F.get(F.col("embedding"), score_index - 1).cast("double"), F.lit(0.0))
    return silver.withColumn("quality_bucket", F.floor(score * 10) / 10.0)
