"""Scoring model predictions against observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave import constants as K
from skywave.sources import schemas

# Link-budget profiles: (tx power W, tx antenna gain dBi, rx antenna gain dBi).
# The baseline 'wspr' profile is the reference station (0 dB advantage); the
# others are typical stations, given here because the source defines none.
STATION_PROFILES = {"wspr": (K.WSPR_REFERENCE_POWER_W, 0.0, 0.0), "portable": (5.0, 0.0, 0.0), "contest": (1500.0, 10.0, 10.0)}


def seed_mode_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.MODE_THRESHOLDS, schemas.MODE_THRESHOLDS)


def observed_mode_thresholds(modes: DataFrame, thresholds: DataFrame, mode_map: dict | None = None) -> DataFrame:
    """Thresholds of the modes actually observed (``modes``: a ``mode`` column,
    one row per observation): per observed mode its ADIF mode, family,
    threshold (NULL when none applies) and the number of observations."""
    mode_map = K.CONTEST_MODE_TO_ADIF if mode_map is None else mode_map
    adif = F.col("mode")
    for src, dst in mode_map.items():
        adif = F.when(F.col("mode") == src, dst).otherwise(adif)
    per = modes.groupBy("mode").agg(F.count(F.lit(1)).alias("observations")).withColumn("adif_mode", adif)
    th = thresholds.select(F.col("mode").alias("adif_mode"), "family", "threshold_db", "description")
    return per.join(th, "adif_mode", "left").select("mode", "adif_mode", "family", "threshold_db", "description",
                                                    "observations")


def threshold_usage(modes: DataFrame, thresholds: DataFrame, mode_map: dict | None = None) -> DataFrame:
    """The whole threshold table with the number of observations of each mode
    (``modes``: a ``mode`` column, one row per observation), 0 where there is none."""
    mode_map = K.CONTEST_MODE_TO_ADIF if mode_map is None else mode_map
    adif = F.col("mode")
    for src, dst in mode_map.items():
        adif = F.when(F.col("mode") == src, dst).otherwise(adif)
    per = modes.groupBy(adif.alias("__m")).agg(F.count(F.lit(1)).alias("__n"))
    return (thresholds.join(per, F.col("mode") == F.col("__m"), "left")
            .select("mode", "family", "threshold_db", "description", F.coalesce("__n", F.lit(0)).cast("bigint").alias("observations")))


def station_advantage_db(power_w: float, gain_tx_dbi: float = 0.0, gain_rx_dbi: float = 0.0) -> Column:
    """10*log10(P / 0.2 W) + G_tx + G_rx."""
    return F.lit(10.0) * F.log10(F.lit(float(power_w)) / F.lit(K.WSPR_REFERENCE_POWER_W)) + F.lit(gain_tx_dbi + gain_rx_dbi)


def score_paths(pred: DataFrame, thresholds: DataFrame, profile: str = "wspr",
                advantage_db: Column | float | None = None, mode_map: dict | None = None) -> DataFrame:
    """Per path: snr_error, the four family viability flags and mode_hit.

    adjusted = predicted_snr + station advantage of ``profile``; a family is
    viable when adjusted >= its threshold; mode_hit looks up the observed mode's
    threshold (contest modes map PH->SSB, RY->RTTY) and is NULL for modes
    without one."""
    if advantage_db is None:
        adv = station_advantage_db(*STATION_PROFILES[profile])
    else:
        adv = advantage_db if isinstance(advantage_db, Column) else F.lit(float(advantage_db))
    mode_map = K.CONTEST_MODE_TO_ADIF if mode_map is None else mode_map
    lookup_mode = F.col("actual_mode")
    for src, dst in mode_map.items():
        lookup_mode = F.when(F.col("actual_mode") == src, dst).otherwise(lookup_mode)
    th = thresholds.select(F.col("mode").alias("__m"), F.col("threshold_db").alias("__t"))
    adjusted = F.col("predicted_snr") + adv
    out = pred.withColumn("__lm", lookup_mode).join(th, F.col("__lm") == F.col("__m"), "left")
    out = out.withColumn("profile", F.lit(profile)).withColumn("snr_error", F.col("predicted_snr") - F.col("actual_snr"))
    for name, t in K.FAMILY_FLAGS:
        out = out.withColumn(name, (adjusted >= t).cast("int"))
    out = out.withColumn("mode_hit", F.when(F.col("__t").isNull(), F.lit(None).cast("int"))
                         .otherwise((adjusted >= F.col("__t")).cast("int")))
    return out.drop("__lm", "__m", "__t")


def model_metrics(results: DataFrame, dims: Sequence[str] = ("source", "band")) -> DataFrame:
    """recall = mean(mode_hit) over scored modes, RMSE, bias, MAE and count per group."""
    e = F.col("snr_error")
    return (results.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("paths"), F.avg("mode_hit").alias("recall"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae")))


def model_metrics_sets(results: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """``model_metrics`` for several sets of dimensions in one pass over the results:
    rows are reduced to sums at the finest grain first (map-side), and only these
    sums are added up per grouping set.  A dimension outside a row's set is NULL;
    ``set_id`` has a bit for each of them, the first dimension's the highest."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    e = F.col("snr_error")
    fine = results.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("__n"), F.count("mode_hit").alias("__scored"), F.sum("mode_hit").alias("__hits"),
        F.count(e).alias("__e"), F.sum(e * e).alias("__e2"), F.sum(e).alias("__e1"), F.sum(F.abs(e)).alias("__ea"))
    total = fine.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in dims]).agg(
        F.grouping_id(*dims).cast("bigint").alias("set_id"), *[F.sum(c).alias(c) for c in fine.columns if c not in dims])
    mean = lambda x, n: F.try_divide(F.col(x), F.col(n))
    return total.select(*dims, "set_id", F.col("__n").alias("paths"), mean("__hits", "__scored").alias("recall"),
                        F.sqrt(mean("__e2", "__e")).alias("rmse"), mean("__e1", "__e").alias("bias"), mean("__ea", "__e").alias("mae"))


def band_hour_heatmap(results: DataFrame, metric: str = "mode_hit", hours=range(24)) -> DataFrame:
    """band x hour matrix of mean ``metric`` (pivot on a fixed hour list, so
    no extra job is needed to discover pivot values)."""
    p = results.groupBy("band").pivot("hour", list(hours)).agg(F.avg(metric))
    return p.select("band", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])


def quality_test_metrics(paths: DataFrame, preds: DataFrame, models: Sequence[str] = ("model_snr", "voacap_snr"),
                         low_bands: Sequence[int] = (102, 103, 104)) -> DataFrame:
    """Pearson r and RMSE of each model vs the observed median SNR, per band
    and overall (band 0).  r is NULL where a model or the SNR is constant;
    ``winner`` names the model with the higher r (NULL without both)."""
    j = paths.select("path_id", "band", "median_snr").join(preds, "path_id")
    aggs = []
    for m in models:
        # corr divides by the spreads, which raises for constants under ANSI
        varies = (F.max(m) > F.min(m)) & (F.max("median_snr") > F.min("median_snr"))
        r = F.try_divide(F.covar_pop(m, "median_snr"), F.stddev_pop(m) * F.stddev_pop("median_snr"))
        aggs += [F.when(varies, r).alias(f"r_{m}"),
                 F.sqrt(F.avg((F.col(m) - F.col("median_snr")) ** 2)).alias(f"rmse_{m}")]
    per_band = j.groupBy("band").agg(F.count(F.lit(1)).alias("paths"), *aggs)
    overall = j.agg(F.count(F.lit(1)).alias("paths"), *aggs).withColumn("band", F.lit(0))
    out = per_band.unionByName(overall)
    a, b = models[0], models[1]
    higher = F.when(F.col(f"r_{a}") > F.col(f"r_{b}"), a).when(F.col(f"r_{a}") <= F.col(f"r_{b}"), b)
    return out.withColumn("winner", higher).withColumn("low_band", F.col("band").isin(list(low_bands)).cast("int"))


def quality_test_summary(metrics: DataFrame, models: Sequence[str] = ("model_snr", "voacap_snr")) -> DataFrame:
    """One row over ``quality_test_metrics``: bands won by each model, bands
    without a winner, and the mean difference of r on the low bands."""
    a, b = models[0], models[1]
    bands = metrics.where(F.col("band") != 0)
    delta = F.when(F.col("low_band") == 1, F.col(f"r_{a}") - F.col(f"r_{b}"))
    return bands.agg(F.count(F.lit(1)).alias("bands"), F.count_if(F.col("winner") == a).alias(f"wins_{a}"),
                     F.count_if(F.col("winner") == b).alias(f"wins_{b}"), F.count_if(F.col("winner").isNull()).alias("undecided"),
                     F.avg(delta).alias("low_band_delta_r"))


def step_i_compare(paths: DataFrame, other: DataFrame,
                   keys: Sequence[str] = ("tx_lat", "tx_lon", "rx_lat", "rx_lon", "freq_mhz", "year", "month", "hour_utc"),
                   by: Sequence[str] = ("mode", "year")) -> DataFrame:
    """Agreement of two models' band-open verdicts on the same paths.

    The reference joins the two tables on the 8 path values; when a path
    repeats on both sides that join yields every pair.  Here each side is
    first reduced to (rows, open rows) per path key, and the pair counts follow
    arithmetically -- matches = a1*b1 + a0*b0 -- so the result equals the
    pairwise join's exactly without emitting a single pair.  Float keys are
    matched on 1e-3-degree / kHz integers."""
    def kcols(df):
        out = []
        for k in keys:
            if k in ("tx_lat", "tx_lon", "rx_lat", "rx_lon", "freq_mhz"):
                out.append(F.round(F.col(k) * 1000).cast("bigint").alias(f"__k_{k}"))
            else:
                out.append(F.col(k).alias(f"__k_{k}"))
        return out
    kn = [f"__k_{k}" for k in keys]
    extra = [b for b in by if b not in keys]
    a = (paths.select(*kcols(paths), *[F.col(b) for b in extra], "band_open")
              .groupBy(*kn, *extra).agg(F.count(F.lit(1)).alias("na"), F.sum("band_open").alias("a1")))
    b = (other.select(*kcols(other), "voacap_band_open")
              .groupBy(*kn).agg(F.count(F.lit(1)).alias("nb"), F.sum("voacap_band_open").alias("b1")))
    j = a.join(b, kn, "inner")
    pairs = F.col("na") * F.col("nb")
    matches = F.col("a1") * F.col("b1") + (F.col("na") - F.col("a1")) * (F.col("nb") - F.col("b1"))
    grp = [F.col(f"__k_{x}").alias(x) if x in keys else F.col(x) for x in by]
    return (j.groupBy(*grp).agg(F.sum(pairs).alias("paths"), F.sum(matches).alias("__m"),
                                F.sum(F.col("a1") * F.col("nb")).alias("__o"), F.sum(F.col("na") * F.col("b1")).alias("__v"))
             .select(*by, "paths", (F.col("__m") / F.col("paths")).alias("match_rate"),
                     (F.col("__o") / F.col("paths")).alias("open_rate"),
                     (F.col("__v") / F.col("paths")).alias("other_open_rate")))


def band_open(snr: Column, threshold: Column) -> Column:
    return (snr >= threshold).cast("int")
