"""Deterministic samples: hash order, stratified cells, density-weighted
(Efraimidis-Spirakis) gold sets, and the quality-test paths.

Exact top-k per group
---------------------
``top_k`` keeps the k best rows of each group by an order column.  Up to the k for
which Spark plans a rank limit before the exchange
(``spark.sql.optimizer.windowGroupLimitThreshold``) the input is read once: each
task keeps its own k best rows of every group, and those are ranked.  For more, a
task's k best would be most of its rows, and exact counts say which rows to keep:

1. every row gets a bucket, a monotone function of its order value (64 buckets per
   power of two, so buckets are finest where the best values of hashes and of
   Efraimidis-Spirakis keys lie); rows are counted per (group, bucket), combined
   map-side;
2. a running sum over each group's buckets (a few thousand rows at most) gives
   every bucket its offset; buckets that start at k or later are dropped;
3. rows join their bucket's offset (null-safe on the group) -- which drops all rows
   that can't be among the k best -- and rank = offset + row_number in the bucket.

No quantile estimate, repair or collect: the k-th row's bucket is found from exact
counts, and no task ranks more than one bucket of one group.  Both ways give the
same rows (a test compares them); k alone decides, not the input.  NULL groups are a group like any other; NULL and NaN order values come last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywave import constants as K
from skywave.functions.bands import band_freq_mhz
from skywave.functions.grid import maidenhead_lat, maidenhead_lon, midpoint_lat_expr
from skywave.functions.hashing import hash_u, hash_u32
from skywave.functions.solar import kp_penalty, ssn_from_sfi, ssn_quintile
from skywave.operators.solar import join_solar_bucketed
from skywave.sources.sinks import window_filter

BUCKETS_PER_OCTAVE = 64


def order_bucket(v: Column) -> Column:
    """A monotone integer of a double: 0 for 0, logarithmic on either side, the
    last bucket for NULL and NaN."""
    size = F.floor((F.log2(F.abs(v)) + 1100.0) * BUCKETS_PER_OCTAVE) + 1
    return (F.when(v.isNull() | F.isnan(v), F.lit(1 << 40)).when(v == 0, F.lit(0))
             .when(v > 0, size).otherwise(-size).cast("bigint"))


def top_k(df: DataFrame, k: int, order_col: str, descending: bool = False, group_cols: Sequence[str] = (),
          tie_cols: Sequence[str] = (), by_counts: bool | None = None) -> DataFrame:
    """The k first rows of each group ordered by ``order_col`` (then ``tie_cols``),
    exact, with a ``sample_rank`` column; see the module notes for the plan.
    ``by_counts`` chooses the way, which k does by default."""
    groups = list(group_cols)
    sign = -1.0 if descending else 1.0
    x = df.withColumn("__o", F.col(order_col).cast("double") * F.lit(sign))   # smaller is better
    order = [F.col("__o").asc_nulls_last(), *[F.col(t).asc() for t in tie_cols]]
    if by_counts is None:
        by_counts = k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if not by_counts:
        within = Window.partitionBy(*groups).orderBy(*order)
        return x.withColumn("sample_rank", F.row_number().over(within)).where(F.col("sample_rank") <= k).drop("__o")
    x = x.withColumn("__b", order_bucket(F.col("__o")))
    counts = x.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0))).where(F.col("__off") < k)
                     .select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__b").alias("__ob"), "__off"))
    on = F.col("__b") == F.col("__ob")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    near = x.join(offsets, on)
    rank = Window.partitionBy(*groups, "__b").orderBy(*order)
    return (near.withColumn("sample_rank", F.col("__off") + F.row_number().over(rank)).where(F.col("sample_rank") <= k)
                .drop("__o", "__b", "__ob", "__off", *[f"__g{i}" for i in range(len(groups))]))


def sample_key_cols() -> list[Column]:
    return [F.unix_micros("timestamp"), F.col("callsign"), F.col("reporter"), F.col("grid"), F.col("reporter_grid"), F.col("id")]


def hash_sample(df: DataFrame, n: int, key_cols: Sequence, tie_col: str = "id", group_cols: Sequence[str] = ()) -> DataFrame:
    """The n rows with the smallest 32-bit hash of ``key_cols`` (per group)."""
    x = df.withColumn("hash_u32", hash_u32(*key_cols))
    return top_k(x, n, "hash_u32", descending=False, group_cols=group_cols, tie_cols=[tie_col]).drop("sample_rank")


def training_filter(spots: DataFrame, window=K.GOLD_WINDOW, snr_range=K.GOLD_SNR_RANGE,
                    distance_range=K.GOLD_DISTANCE_RANGE) -> DataFrame:
    """Half-open date window, inclusive SNR and distance ranges, both grids
    at least 4 characters."""
    return window_filter(spots, window).where(
        F.col("snr").between(*snr_range) & F.col("distance").between(*distance_range)
        & (F.length("grid") >= 4) & (F.length("reporter_grid") >= 4))


def _gold_base(spots: DataFrame, solar: DataFrame, window) -> DataFrame:
    s = training_filter(spots, window).select("id", "timestamp", "callsign", "reporter", "grid", "reporter_grid", "snr",
                                              "distance", "band", "azimuth")
    return join_solar_bucketed(s, solar, how="inner", agg="max")


GOLD_COLUMNS = ["snr", "distance", "band", "hour", "month", "azimuth", "tx_grid", "rx_grid", "ssn", "sfi", "kp"]


def _gold_cols(df: DataFrame) -> DataFrame:
    return (df.withColumn("hour", F.hour("timestamp")).withColumn("month", F.month("timestamp"))
              .withColumn("tx_grid", F.col("grid")).withColumn("rx_grid", F.col("reporter_grid")))


def gold_stratified(spots: DataFrame, solar: DataFrame, per_cell: int = K.STRATIFIED_PER_CELL,
                    window=K.GOLD_WINDOW, bands=K.HF_BANDS, cuts=K.SSN_QUINTILE_CUTS) -> DataFrame:
    """``per_cell`` hash-ordered rows per (band, SSN quintile): one job for all
    50 cells instead of 50 sorted queries."""
    base = _gold_base(spots, solar, window).where(F.col("band").isin(list(bands)))
    base = base.withColumn("ssn_quintile", ssn_quintile("ssn", cuts))
    base = base.withColumn("hash_u32", hash_u32(*sample_key_cols()))
    out = top_k(base, per_cell, "hash_u32", group_cols=["band", "ssn_quintile"], tie_cols=["id"])
    return _gold_cols(out).select("id", *GOLD_COLUMNS, "ssn_quintile")


def _lat_bin(midlat: Column, width: int, floor_bins: bool) -> Column:
    """Latitude bin; by default truncation toward zero (as the reference), so
    bin 0 spans (-width, width); ``floor_bins`` gives equal-width bins."""
    if floor_bins:
        return F.floor(midlat / width).cast("int")
    return (midlat.cast("int") / F.lit(width)).cast("int")


def density_cells(df: DataFrame, ssn_width: int = K.DENSITY_SSN_BIN_WIDTH, lat_width: int = K.DENSITY_LAT_BIN_WIDTH,
                  floor_bins: bool = False) -> DataFrame:
    mid = midpoint_lat_expr("grid", "reporter_grid")
    return (df.withColumn("ssn_bin", (F.col("ssn").cast("long") / ssn_width).cast("int"))
              .withColumn("lat_bin", _lat_bin(mid, lat_width, floor_bins)))


def ifw_density(spots: DataFrame, solar: DataFrame, band: int = K.DENSITY_SAMPLE_BAND,
                sample_limit: int = K.DENSITY_SAMPLE_LIMIT, window=K.GOLD_WINDOW, floor_bins: bool = False) -> DataFrame:
    """Histogram over (ssn bin, midpoint-latitude bin) of a hash-ordered sample
    of one band -- the inverse-frequency weights of the continuous gold set."""
    base = _gold_base(spots, solar, window).where(F.col("band") == band)
    sample = hash_sample(base, sample_limit, sample_key_cols())
    cells = density_cells(sample, floor_bins=floor_bins)
    return cells.groupBy("ssn_bin", "lat_bin").agg(F.count(F.lit(1)).alias("cell_count"))


def density_stats(density: DataFrame) -> DataFrame:
    return density.agg(F.count(F.lit(1)).alias("cells"), F.min("cell_count").alias("min_count"),
                       F.max("cell_count").alias("max_count"))


def gold_continuous(spots: DataFrame, solar: DataFrame, density: DataFrame, per_band: int = K.CONTINUOUS_PER_BAND,
                    window=K.GOLD_WINDOW, bands=K.HF_BANDS, floor: int = K.DENSITY_FLOOR, floor_bins: bool = False) -> DataFrame:
    """Density-weighted sample per band (Efraimidis-Spirakis): key
    ln(1e-18 + u) * sqrt(max(cell, floor)) largest first, so rows from sparse
    (ssn, latitude) cells are favoured with weight 1/sqrt(cell)."""
    base = _gold_base(spots, solar, window).where(F.col("band").isin(list(bands)))
    base = density_cells(base, floor_bins=floor_bins)
    # at most (SSN bins) x (latitude bins) rows: a few hundred cells
    base = base.join(F.broadcast(density.select("ssn_bin", "lat_bin", "cell_count")), ["ssn_bin", "lat_bin"], "left")
    cell = F.greatest(F.coalesce(F.col("cell_count"), F.lit(0)), F.lit(floor)).cast("double")
    u = hash_u(F.unix_micros("timestamp"), "grid", "reporter_grid", "id")
    base = (base.withColumn("es_key", F.log(F.lit(1e-18) + u) * F.sqrt(cell))
                .withColumn("midpoint_lat", midpoint_lat_expr("grid", "reporter_grid"))
                .withColumn("sampling_weight", F.lit(1.0) / F.sqrt(cell))
                .withColumn("sfi_dist_interact", F.col("sfi") * F.log10(F.greatest(F.col("distance"), F.lit(1)).cast("double"))))
    out = top_k(base, per_band, "es_key", descending=True, group_cols=["band"], tie_cols=["id"])
    return _gold_cols(out).select("id", *GOLD_COLUMNS, "midpoint_lat", "sampling_weight", "sfi_dist_interact")


def gold_v6(continuous: DataFrame) -> DataFrame:
    """The continuous set plus ``kp_penalty = 1 - kp/9``."""
    return continuous.withColumn("kp_penalty", kp_penalty("kp"))


def ssn_quintile_bounds(spots: DataFrame, solar: DataFrame, window=K.GOLD_WINDOW) -> DataFrame:
    """The four SSN cut points (20/40/60/80 %) of the training spots -- the
    reference ships them as constants; this derives them from the data.  SSN
    has few distinct values, so the exact percentile's buffer stays small."""
    base = _gold_base(spots, solar, window)
    q = F.percentile("ssn", [0.2, 0.4, 0.6, 0.8])
    return base.agg(q.alias("q")).select(*[F.col("q")[i].alias(f"q{i + 1}") for i in range(4)])


def quality_test_paths(sig: DataFrame, per_band: int = K.QUALITY_TEST_PER_BAND, min_spots: int = K.QUALITY_TEST_MIN_SPOTS,
                       seed: str = "quality-test") -> DataFrame:
    """``per_band`` signatures per band (spot_count > ``min_spots``) in seeded
    hash order, with grid centres, band centre frequency and SSN from SFI.
    path_id numbers bands in order, then the sample order inside a band; the
    band offsets come from a tiny per-band count."""
    s = sig.where(F.col("spot_count") > min_spots)
    s = s.withColumn("__h", hash_u32("tx_grid_4", "rx_grid_4", "band", "hour", "month", seed=seed))
    s = top_k(s, per_band, "__h", group_cols=["band"], tie_cols=["tx_grid_4", "rx_grid_4", "hour", "month"])
    counts = s.groupBy("band").agg(F.count(F.lit(1)).alias("__c"))
    wo = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)   # <= number of bands rows
    counts = counts.withColumn("__off", F.coalesce(F.sum("__c").over(wo), F.lit(0)))
    s = s.join(F.broadcast(counts), "band")   # one row per band (the signature bands)
    return s.select(
        (F.col("__off") + F.col("sample_rank")).cast("bigint").alias("path_id"), "tx_grid_4", "rx_grid_4",
        maidenhead_lat("tx_grid_4").alias("tx_lat"), maidenhead_lon("tx_grid_4").alias("tx_lon"),
        maidenhead_lat("rx_grid_4").alias("rx_lat"), maidenhead_lon("rx_grid_4").alias("rx_lon"),
        "band", band_freq_mhz("band").alias("freq_mhz"), "hour", "month", "spot_count", "median_snr", "snr_std",
        "reliability", "avg_sfi", "avg_kp", "avg_distance", ssn_from_sfi("avg_sfi").alias("ssn"))
