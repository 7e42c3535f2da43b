"""Median path signatures: WSPR v1/v2, contest, RBN, DXpedition; union and reports.

A signature is one row per (tx_grid_4, rx_grid_4, band, hour, month) with the
median SNR, count, spread, reliability and average solar/path values.

Plan: pruned scan -> filters pushed to the scan -> broadcast solar buckets ->
partial aggregation per task -> one exchange on the five keys -> HAVING.  The
exact median is ``percentile``, whose buffer holds (SNR, count) pairs: SNR is a
small integer, so a hot group is reduced to its histogram before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywave import constants as K
from skywave.functions.geo import azimuth_deg, great_circle_km
from skywave.functions.grid import grid4, maidenhead_lat, maidenhead_lon
from skywave.operators.callsigns import enrich_endpoints
from skywave.operators.intervals import interval_join, interval_join_blocks
from skywave.operators.solar import attach_solar
from skywave.sources.schemas import SIGNATURE_COLUMNS
from skywave.sources.sinks import window_filter


def _trunc_long(c: Column) -> Column:
    """double -> unsigned-int style truncation, after rounding away ulp noise."""
    return F.round(c, 6).cast("bigint")


def _key_cols(ts: str) -> list[Column]:
    return [F.hour(ts).alias("hour"), F.month(ts).alias("month")]


def _solar_aggs() -> list[Column]:
    return [F.avg("sfi").alias("avg_sfi"), F.avg("kp").alias("avg_kp")]


def _finish(df: DataFrame, min_spots: int) -> DataFrame:
    return df.where(F.col("spot_count") >= min_spots).select(*SIGNATURE_COLUMNS)


def _with_centroid_geometry(df: DataFrame) -> DataFrame:
    """Distance/azimuth between the two 4-char grid centres, computed once per
    output row (the value is constant within a group, so it is computed after
    the aggregation instead of per spot)."""
    tlon, tlat = maidenhead_lon("tx_grid_4"), maidenhead_lat("tx_grid_4")
    rlon, rlat = maidenhead_lon("rx_grid_4"), maidenhead_lat("rx_grid_4")
    return (df.withColumn("avg_distance", _trunc_long(great_circle_km(tlon, tlat, rlon, rlat)))
              .withColumn("avg_azimuth", _trunc_long(azimuth_deg(tlon, tlat, rlon, rlat))))


KEYS = ["tx_grid_4", "rx_grid_4", "band", "hour", "month"]


def _snr_aggs(reliable_above: float | None = None) -> list[Column]:
    """Median (exact, interpolated), count, population spread and the share of
    SNR above ``reliable_above``.  ``percentile`` keeps (value, count) pairs, so
    its map-side buffers are the group's SNR histogram: one exchange moves them.
    The spread comes from exact integer sums."""
    n, x = F.count(F.lit(1)), F.col("snr").cast("bigint")
    dec = "decimal(38,0)"
    spread = n.cast(dec) * F.sum(x * x).cast(dec) - F.sum(x).cast(dec) * F.sum(x).cast(dec)
    aggs = [F.percentile("snr", 0.5).alias("median_snr"), n.alias("spot_count"),
            (F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0))) / n).alias("snr_std")]
    if reliable_above is not None:
        aggs.append((F.count_if(F.col("snr") > reliable_above) / n).alias("reliability"))
    return aggs


def wspr_signatures(spots: DataFrame, solar: DataFrame | None, min_spots: int = K.WSPR_MIN_SPOTS,
                    bands=K.HF_BANDS, min_distance: int = K.MIN_DISTANCE_KM, solar_mode: str = "bucketed",
                    circular_azimuth: bool = False) -> DataFrame:
    """Signatures v1 from WSPR spots (ground-wave paths under ``min_distance`` dropped)."""
    s = spots.select("timestamp", "grid", "reporter_grid", "band", "snr", "distance", "azimuth")
    s = s.where((F.col("distance") >= min_distance) & F.col("band").isin(list(bands)))
    if solar is not None:
        s = attach_solar(s, solar, solar_mode)
    else:
        s = s.withColumn("sfi", F.lit(0.0)).withColumn("kp", F.lit(0.0))
    if circular_azimuth:
        az = F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians("azimuth"))), F.avg(F.cos(F.radians("azimuth"))))) + 360.0, F.lit(360.0))
    else:
        az = F.avg("azimuth")
    agg = (s.groupBy(grid4("grid").alias("tx_grid_4"), grid4("reporter_grid").alias("rx_grid_4"), "band", *_key_cols("timestamp"))
            .agg(*_snr_aggs(K.RELIABLE_SNR_DB), *_solar_aggs(),
                 F.avg("distance").cast("bigint").alias("avg_distance"),
                 az.cast("bigint").alias("avg_azimuth")))
    return _finish(agg, min_spots)


def exclude_flagged(spots: DataFrame, flags: DataFrame, rx_type2: bool = True, rx_velocity: bool = False) -> DataFrame:
    """Drop spots of type-2 telemetry callsigns (TX, and RX when ``rx_type2``)
    and of (callsign, date) velocity flight days (TX; RX with ``rx_velocity``).
    One left-anti join per endpoint (the reference's NOT IN): a type-2 entry has
    no date and matches every day."""
    kinds = F.col("flag_reason").isin("type2_telemetry", "velocity_day")
    f = flags.where(kinds).select(F.col("callsign").alias("__fc"), F.col("flag_reason").alias("__fr"),
                                  F.when(F.col("flag_reason") == "velocity_day", F.col("flag_date")).alias("__fd")).distinct()
    day = F.to_date("timestamp")

    def drop(df: DataFrame, endpoint: str, entries: DataFrame) -> DataFrame:
        hit = (F.col(endpoint) == F.col("__fc")) & (F.col("__fd").isNull() | (F.col("__fd") == day))
        return df.join(entries, hit, "left_anti")

    out = drop(spots, "callsign", f)
    rx = [r for r, on in (("type2_telemetry", rx_type2), ("velocity_day", rx_velocity)) if on]
    return drop(out, "reporter", f.where(F.col("__fr").isin(rx))) if rx else out


def wspr_signatures_v2(spots: DataFrame, solar: DataFrame | None, flags: DataFrame, **kw) -> DataFrame:
    """Terrestrial signatures: v1 over spots without balloon/telemetry traffic."""
    rx_velocity = kw.pop("rx_velocity", False)
    return wspr_signatures(exclude_flagged(spots, flags, rx_velocity=rx_velocity), solar, **kw)


def contest_signatures(qsos: DataFrame, cg: DataFrame, solar: DataFrame | None, min_spots: int = K.CONTEST_MIN_SPOTS,
                       window=K.CONTEST_WINDOW, modes=K.CONTEST_MODES, anchors=K.CONTEST_ANCHOR_SNR,
                       bands=K.HF_BANDS, solar_mode: str = "bucketed") -> DataFrame:
    """Contest QSOs -> signatures with an anchored SNR per mode (SSB +10 dB,
    RTTY 0 dB), spread 0 and reliability 1.  Mode is a hidden grouping key, so
    one path can have one row per mode."""
    q = window_filter(qsos, window).select("timestamp", "band", "mode", "call_1", "call_2")
    q = q.where(F.col("mode").isin(list(modes)) & F.col("band").isin(list(bands)))
    q = enrich_endpoints(q, cg, "call_1", "call_2")
    q = attach_solar(q, solar, solar_mode) if solar is not None else q.withColumn("sfi", F.lit(0.0)).withColumn("kp", F.lit(0.0))
    anchor = None
    for m, v in anchors.items():
        anchor = F.when(F.col("mode") == m, float(v)) if anchor is None else anchor.when(F.col("mode") == m, float(v))
    agg = (q.groupBy("tx_grid_4", "rx_grid_4", "band", *_key_cols("timestamp"), "mode")
            .agg(F.count(F.lit(1)).alias("spot_count"), *_solar_aggs())
            .withColumn("median_snr", anchor.cast("double"))
            .withColumn("snr_std", F.lit(0.0))
            .withColumn("reliability", F.lit(1.0)))
    return _finish(_with_centroid_geometry(agg), min_spots)


def rbn_signatures(rbn: DataFrame, cg: DataFrame, solar: DataFrame | None, min_spots: int = K.RBN_MIN_SPOTS,
                   window=K.RBN_WINDOW, modes=K.RBN_MODES, snr_range=K.RBN_SNR_RANGE, bands=K.HF_BANDS,
                   solar_mode: str = "bucketed") -> DataFrame:
    """RBN skimmer spots -> signatures with the real median SNR.  The spotted
    station (dx_call) is TX, the skimmer (de_call) is RX."""
    r = window_filter(rbn, window).select("timestamp", "band", "dx_call", "de_call", "snr", "tx_mode")
    lo, hi = snr_range
    r = r.where(F.col("tx_mode").isin(list(modes)) & F.col("snr").between(lo, hi) & F.col("band").isin(list(bands)))
    r = enrich_endpoints(r, cg, "dx_call", "de_call")
    r = attach_solar(r, solar, solar_mode) if solar is not None else r.withColumn("sfi", F.lit(0.0)).withColumn("kp", F.lit(0.0))
    return _finish(_with_centroid_geometry(_median_snr_agg(r)), min_spots)


def _median_snr_agg(df: DataFrame) -> DataFrame:
    """Median/std/count/solar averages of ``snr`` per signature key, reliability 1."""
    return (df.groupBy("tx_grid_4", "rx_grid_4", "band", *_key_cols("timestamp"))
              .agg(*_snr_aggs(), *_solar_aggs()).withColumn("reliability", F.lit(1.0)))


def merge_windows(catalog: DataFrame) -> DataFrame:
    """A catalog whose windows of one callsign and grid don't overlap: each stretch
    of time that some window covers, with ``windows``, how many do.

    Starts count +1, the moments after the (inclusive) ends -1; the running sum
    between two such moments is the number of open windows.  No rows are lost: a
    spot in a stretch stands for ``windows`` spots, one in each window.  Entities
    aren't kept apart."""
    c = catalog.select("callsign", "grid", F.unix_micros("start_ts").alias("__lo"), F.unix_micros("end_ts").alias("__hi"))
    moments = F.array(F.struct(F.col("__lo").alias("__t"), F.lit(1).alias("__n")),
                      F.struct((F.col("__hi") + 1).alias("__t"), F.lit(-1).alias("__n")))
    steps = (c.where("__lo <= __hi").select("callsign", "grid", F.inline(moments))
              .groupBy("callsign", "grid", "__t").agg(F.sum("__n").alias("__n")))
    w = Window.partitionBy("callsign", "grid").orderBy("__t")
    open_now = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (steps.select("callsign", "grid", F.timestamp_micros("__t").alias("start_ts"),
                         F.timestamp_micros(F.lead("__t").over(w) - 1).alias("end_ts"), open_now.alias("windows"))
                 .where("windows > 0"))


def dxpedition_paths(rbn: DataFrame, catalog: DataFrame, cg: DataFrame, cell_days: float = 5.0,
                     spread: Sequence[Column | str] | None = None) -> DataFrame:
    """RBN spots of catalogued DXpedition callsigns inside their operating
    window (inclusive), with the skimmer's grid from the callsign dimension.
    A catalog of ``merge_windows`` gives a spot once per grid, with ``windows``.

    A callsign may have thousands of windows, so there can be far more paths than
    spots: the skimmers are looked up first, and the last step joins the spots with
    the windows by callsign and time cell of ``cell_days`` (about a short window's
    length; it decides how many windows a spot meets, not which rows come out) in
    blocks of as many pairs each.  Nothing after it moves the paths.  Where a spot
    meets few windows, ``spread`` lays the spots over all tasks by its hash instead."""
    merged = "windows" in catalog.columns
    cat = catalog.select(F.col("callsign").alias("__cc"), F.lit(None).cast("string").alias("dx_entity") if merged else F.col("entity").alias("dx_entity"),
                         F.col("grid").alias("dx_grid"), F.unix_micros("start_ts").alias("__lo"), F.unix_micros("end_ts").alias("__hi"),
                         *(["windows"] if merged else []))
    dim = cg.where(F.col("grid_4") != "").select(F.col("callsign").alias("__sc"), F.col("grid").alias("skimmer_grid"))
    spots = rbn.select("timestamp", "dx_call", "de_call", "band", "frequency", "snr", "tx_mode")
    spots = spots.join(dim, F.col("de_call") == F.col("__sc"), "inner").drop("__sc")
    # a few MB of spots can make GBs of paths, so their bytes don't tell how many tasks are due
    tasks = max(int(rbn.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * rbn.sparkSession.sparkContext.defaultParallelism)
    near = {"at": F.unix_micros("timestamp"), "lo": "__lo", "hi": "__hi", "width": cell_days * 86_400e6, "on": [("dx_call", "__cc")]}
    j = interval_join(spots.repartition(tasks, *spread), cat, **near) if spread else interval_join_blocks(spots, cat, tasks=tasks, **near)
    return j.select("timestamp", "dx_call", "dx_entity", "dx_grid", F.col("de_call").alias("skimmer_call"),
                    "skimmer_grid", "band", "frequency", "snr", "tx_mode",
                    F.lit("rbn-dxpedition-synthesis").alias("source_type"), *(["windows"] if merged else []))


def signature_spread() -> list[Column]:
    """A ``spread`` for ``dxpedition_paths``: spots of one receiver grid, band, hour and
    month go to one task, so signatures are aggregated where their paths arise."""
    return [grid4("skimmer_grid"), F.col("band"), F.hour("timestamp"), F.month("timestamp")]


def _weighted_snr_agg(df: DataFrame, weight: str) -> DataFrame:
    """``_median_snr_agg`` of rows that stand for ``weight`` rows each: one row per
    signature key and SNR first, then the weighted median and moments."""
    w = F.col(weight)
    hist = (df.groupBy("tx_grid_4", "rx_grid_4", "band", *_key_cols("timestamp"), "snr")
              .agg(F.sum(w).alias("__n"),
                   *[f for c in ("sfi", "kp") for f in (F.sum(F.col(c) * w).alias(f"__{c}"), F.sum(F.when(F.col(c).isNotNull(), w)).alias(f"__n_{c}"))]))
    n, x, dec = F.sum("__n"), F.col("snr").cast("bigint"), "decimal(38,0)"
    wx, wxx = F.sum(F.col("__n") * x), F.sum(F.col("__n") * x * x)
    spread = n.cast(dec) * wxx.cast(dec) - wx.cast(dec) * wx.cast(dec)
    return hist.groupBy(*KEYS).agg(
        F.percentile("snr", 0.5, F.col("__n")).alias("median_snr"), n.alias("spot_count"),
        (F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0))) / n).alias("snr_std"),
        *[F.try_divide(F.sum(f"__{c}"), F.sum(f"__n_{c}")).alias(f"avg_{c}") for c in ("sfi", "kp")]).withColumn("reliability", F.lit(1.0))


def dxpedition_signatures(paths: DataFrame, solar: DataFrame | None, min_spots: int = 1, replicate: int = 1) -> DataFrame:
    """DXpedition paths reduced to the 13-column signature shape; ``replicate``
    up-samples rare entities by emitting each signature ``replicate`` times.
    Paths of merged windows count ``windows`` times."""
    p = paths.withColumn("tx_grid_4", grid4("dx_grid")).withColumn("rx_grid_4", grid4("skimmer_grid"))
    p = attach_solar(p, solar) if solar is not None else p.withColumn("sfi", F.lit(0.0)).withColumn("kp", F.lit(0.0))
    agg = _weighted_snr_agg(p, "windows") if "windows" in paths.columns else _median_snr_agg(p)
    out = _finish(_with_centroid_geometry(agg), min_spots)
    if replicate > 1:
        out = out.withColumn("replica", F.explode(F.sequence(F.lit(1), F.lit(replicate)))).drop("replica")
    return out


def union_signatures(**sets: DataFrame) -> DataFrame:
    """UNION ALL of signature sets with a ``source`` tag (e.g. wspr floor,
    contest ceiling, rbn middle)."""
    out = None
    for name, df in sets.items():
        tagged = df.select(*SIGNATURE_COLUMNS).withColumn("source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def signature_report(sig: DataFrame) -> DataFrame:
    """Per band: signatures, avg median SNR (0.1 dB), avg spots, avg distance."""
    return (sig.groupBy("band").agg(
        F.count(F.lit(1)).alias("signatures"),
        F.round(F.avg("median_snr"), 1).alias("avg_snr"),
        F.round(F.avg("spot_count"), 0).alias("avg_spots"),
        F.round(F.avg("avg_distance"), 0).alias("avg_dist_km")).orderBy("band"))


def snr_distribution(sig: DataFrame) -> DataFrame:
    """p10 / p50 / p90 of the signatures' median SNR (exact, interpolated)."""
    q = F.percentile("median_snr", [0.1, 0.5, 0.9])
    return sig.agg(q.alias("q")).select(F.round(F.col("q")[0], 1).alias("p10"), F.round(F.col("q")[1], 1).alias("p50"),
                                        F.round(F.col("q")[2], 1).alias("p90"))


def coverage_metrics(sig: DataFrame) -> DataFrame:
    """Same-grid signatures and the share with solar data attached."""
    return sig.agg(F.count(F.lit(1)).alias("signatures"),
                   F.count_if(F.col("tx_grid_4") == F.col("rx_grid_4")).alias("same_grid"),
                   F.round(F.try_divide(F.count_if(F.col("avg_sfi") > 0) * 100.0, F.count(F.lit(1))), 1).alias("solar_pct"))


def signature_delta(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Rows removed from v1 by the v2 filters and the share in percent."""
    u = v1.select(F.lit(1).alias("v")).unionByName(v2.select(F.lit(2).alias("v")))
    return (u.agg(F.count_if(F.col("v") == 1).alias("v1_rows"), F.count_if(F.col("v") == 2).alias("v2_rows"))
             .withColumn("removed", F.col("v1_rows") - F.col("v2_rows"))
             .withColumn("removed_pct", F.round(F.try_divide(F.col("removed") * 100.0, F.col("v1_rows")), 3)))


def rows_by_band(df: DataFrame) -> DataFrame:
    return df.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).orderBy("band")


def anchor_counts(sig: DataFrame) -> DataFrame:
    """Contest signatures by anchor: SSB (+10 dB) and RTTY (0 dB)."""
    return sig.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("median_snr") == 10).alias("ssb"),
                   F.count_if(F.col("median_snr") == 0).alias("rtty"))
