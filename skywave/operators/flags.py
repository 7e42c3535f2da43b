"""Balloon / telemetry transmitter flags (v2 date-level and deprecated v1).

Distinct grids per (callsign, day) are counted in two aggregation levels:
(callsign, day, grid_4) first, then (callsign, day).  Both levels aggregate
partially before their shuffle, so a hot callsign is reduced on the map side
and no task ever holds all of one callsign's spots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skywave import constants as K
from skywave.functions.grid import grid4

FLAG_COLUMNS = ["callsign", "flag_reason", "flag_date", "daily_grids", "total_spots"]
V1_COLUMNS = ["callsign", "flag_reason", "max_daily_grids", "total_spots", "total_grids", "first_seen", "last_seen"]


def _daily_grid_counts(spots: DataFrame | None, summary: DataFrame | None = None) -> DataFrame:
    """(callsign, d, g4, n) of transmitted spots whose grid has a valid field
    prefix -- from the station-day summary when given (no bronze scan)."""
    if summary is not None:
        return (summary.where((F.col("side") == 0) & F.col("valid_field"))
                .groupBy("callsign", "d", grid4("grid6").alias("g4")).agg(F.sum("n").alias("n")))
    return (spots.where(F.col("grid").rlike(K.FIELD_PREFIX_PATTERN))
            .groupBy("callsign", F.to_date("timestamp").alias("d"), grid4("grid").alias("g4"))
            .agg(F.count(F.lit(1)).alias("n")))


def daily_grids(spots: DataFrame | None, summary: DataFrame | None = None) -> DataFrame:
    """(callsign, d, daily_grids, daily_spots)."""
    return (_daily_grid_counts(spots, summary).groupBy("callsign", "d")
            .agg(F.count(F.lit(1)).alias("daily_grids"), F.sum("n").alias("daily_spots")))


def velocity_day(spots: DataFrame | None, threshold: int = K.VELOCITY_GRIDS_PER_DAY,
                 summary: DataFrame | None = None) -> DataFrame:
    """(callsign, date) pairs with at least ``threshold`` distinct 4-char grids:
    only that day is flagged, the callsign's other days stay usable."""
    return (daily_grids(spots, summary).where(F.col("daily_grids") >= threshold)
            .select("callsign", F.lit("velocity_day").alias("flag_reason"), F.col("d").alias("flag_date"),
                    F.col("daily_grids").cast("bigint").alias("daily_grids"),
                    F.col("daily_spots").cast("bigint").alias("total_spots")))


def _callsign_set(df: DataFrame) -> DataFrame:
    return df.select(F.col("callsign").alias("__x")).distinct()


def type2_telemetry(spots: DataFrame | None, cg: DataFrame, flagged: DataFrame | None = None,
                    summary: DataFrame | None = None) -> DataFrame:
    """Transmitters absent from the callsign dimension (never sent a valid
    upper-case grid), minus callsigns already flagged.  Spots are reduced to
    (callsign, count) before the anti joins: the joins see one row per
    callsign, not one per spot."""
    if summary is not None:
        per_call = summary.where(F.col("side") == 0).groupBy("callsign").agg(F.sum("n").alias("total_spots"))
    else:
        per_call = spots.groupBy("callsign").agg(F.count(F.lit(1)).alias("total_spots"))
    known = cg.select(F.col("callsign").alias("__k"))
    out = per_call.join(known, F.col("callsign") == F.col("__k"), "left_anti")
    if flagged is not None:
        out = out.join(_callsign_set(flagged), F.col("callsign") == F.col("__x"), "left_anti")
    return out.select("callsign", F.lit("type2_telemetry").alias("flag_reason"),
                      F.lit(K.EPOCH_FLAG_DATE).cast("date").alias("flag_date"),
                      F.lit(0).cast("bigint").alias("daily_grids"), F.col("total_spots").cast("bigint"))


def balloon_flags_v2(spots: DataFrame | None, cg: DataFrame, threshold: int = K.VELOCITY_GRIDS_PER_DAY,
                     summary: DataFrame | None = None) -> DataFrame:
    """Velocity days, then type-2 telemetry (a later category skips callsigns
    of the earlier one).  Both derive from the station-day summary (one bronze
    scan for the chain); it is built here when not given."""
    from skywave.operators.callsigns import station_days
    summary = station_days(spots) if summary is None else summary
    vd = velocity_day(None, threshold, summary=summary)
    t2 = type2_telemetry(None, cg, flagged=vd, summary=summary)
    return vd.unionByName(t2).select(*FLAG_COLUMNS)


def flag_summary(flags: DataFrame, spots: DataFrame | None = None) -> DataFrame:
    """Per flag reason: entries, distinct callsigns, flagged spots; with the
    bronze total, the contamination share in percent.  The total comes from
    one tagged union and a window over the few summary rows (no join)."""
    summary = flags.select("flag_reason", "callsign", F.col("total_spots").cast("bigint").alias("spots"))
    per = summary.groupBy("flag_reason").agg(F.count(F.lit(1)).alias("entries"),
                                             F.countDistinct("callsign").alias("callsigns"),
                                             F.sum("spots").alias("flagged_spots"))
    if spots is None:
        return per
    total = spots.agg(F.count(F.lit(1)).alias("bronze_rows")).select(
        F.lit(None).cast("string").alias("flag_reason"), F.lit(0).cast("bigint").alias("entries"),
        F.lit(0).cast("bigint").alias("callsigns"), F.lit(0).cast("bigint").alias("flagged_spots"), "bronze_rows")
    both = per.withColumn("bronze_rows", F.lit(None).cast("bigint")).unionByName(total)
    w = Window.partitionBy()  # a handful of summary rows
    both = both.withColumn("bronze_rows", F.max("bronze_rows").over(w))
    return (both.where(F.col("flag_reason").isNotNull())
            .withColumn("contamination_pct", F.round(F.col("flagged_spots") * 100.0 / F.col("bronze_rows"), 4)))


def mobility_tier(grids_per_day) -> F.Column:
    """Fixed (1 grid/day), Maritime (< 10), Vehicle (< 25), Fast (>= 45);
    25..44 is left unclassified."""
    g = F.col(grids_per_day) if isinstance(grids_per_day, str) else grids_per_day
    (fixed, f_max), (mar, m_lt), (veh, v_lt), (fast, fast_ge) = K.MOBILITY_TIERS
    return (F.when(g <= f_max, fixed).when(g < m_lt, mar).when(g < v_lt, veh)
            .when(g >= fast_ge, fast).otherwise("Unclassified"))


def mobility_profile(spots: DataFrame | None, summary: DataFrame | None = None) -> DataFrame:
    """Callsign-days per mobility tier."""
    d = daily_grids(spots, summary).withColumn("tier", mobility_tier("daily_grids"))
    return d.groupBy("tier").agg(F.count(F.lit(1)).alias("callsign_days"), F.sum("daily_spots").alias("spots"),
                                 F.countDistinct("callsign").alias("callsigns"))


# ---------------------------------------------------------------- v1 (deprecated)
def callsign_days(spots: DataFrame) -> DataFrame:
    """(callsign, d, g4, valid, n) of transmitted spots: the one reduction of the
    fact table that all v1 categories derive from."""
    valid = F.col("grid").rlike(K.FIELD_PREFIX_PATTERN)
    return (spots.groupBy("callsign", F.to_date("timestamp").alias("d"), grid4("grid").alias("g4"), valid.alias("valid"))
            .agg(F.count(F.lit(1)).alias("n")))


def _per_callsign(days: DataFrame) -> DataFrame:
    """One row per callsign: spots, distinct 4-char grids, first and last day."""
    per_grid = days.groupBy("callsign", "g4").agg(F.sum("n").alias("n"), F.min("d").alias("f"), F.max("d").alias("l"))
    return per_grid.groupBy("callsign").agg(F.sum("n").alias("total_spots"), F.count(F.lit(1)).alias("total_grids"),
                                            F.min("f").alias("first_seen"), F.max("l").alias("last_seen"))


def _without(calls: DataFrame, *others: DataFrame | None) -> DataFrame:
    """Callsigns (one row each) that none of the others has."""
    for o in others:
        if o is not None:
            calls = calls.join(_callsign_set(o), F.col("callsign") == F.col("__x"), "left_anti")
    return calls


def _v1_rows(calls: DataFrame, reason: str) -> DataFrame:
    return calls.select("callsign", F.lit(reason).alias("flag_reason"), F.lit(0).cast("bigint").alias("max_daily_grids"),
                        F.col("total_spots").cast("bigint"), F.col("total_grids").cast("bigint"), "first_seen", "last_seen")


def velocity_tier_v1(spots: DataFrame | None, threshold: int = K.VELOCITY_GRIDS_PER_DAY, days: DataFrame | None = None) -> DataFrame:
    """Whole-callsign flag: peak daily distinct grids >= threshold, with totals.

    The reference's distinct-count window becomes (callsign, day, grid) ->
    (callsign, day) -> callsign aggregations."""
    valid = (callsign_days(spots) if days is None else days).where("valid")
    per_day = valid.groupBy("callsign", "d").agg(F.count(F.lit(1)).alias("dg"))
    peak = per_day.groupBy("callsign").agg(F.max("dg").alias("max_daily_grids")).where(F.col("max_daily_grids") >= threshold)
    return (peak.join(_per_callsign(valid), "callsign")
            .select("callsign", F.lit("velocity_tier").alias("flag_reason"),
                    F.col("max_daily_grids").cast("bigint").alias("max_daily_grids"),
                    F.col("total_spots").cast("bigint").alias("total_spots"),
                    F.col("total_grids").cast("bigint").alias("total_grids"), "first_seen", "last_seen"))


def type2_telemetry_v1(spots: DataFrame | None, cg: DataFrame, flagged: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Callsigns that are neither in the dimension nor flagged: the anti joins
    see one row per callsign."""
    calls = _per_callsign(callsign_days(spots) if days is None else days)
    return _v1_rows(_without(calls, cg, flagged), "type2_telemetry")


def reserved_prefix_v1(spots: DataFrame | None, cg: DataFrame, flagged: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Callsigns starting with Q or two digits (ITU-reserved), not flagged and
    not known operators."""
    cond = None
    for p in K.RESERVED_PREFIX_PATTERNS:
        cond = F.col("callsign").rlike(p) if cond is None else cond | F.col("callsign").rlike(p)
    calls = _per_callsign((callsign_days(spots) if days is None else days).where(cond))
    return _v1_rows(_without(calls, flagged, cg), "reserved_prefix")


def balloon_flags_v1(spots: DataFrame, cg: DataFrame, threshold: int = K.VELOCITY_GRIDS_PER_DAY) -> DataFrame:
    days = callsign_days(spots)
    vt = velocity_tier_v1(None, threshold, days=days)
    t2 = type2_telemetry_v1(None, cg, flagged=vt, days=days)
    done = vt.select("callsign").unionByName(t2.select("callsign"))
    rp = reserved_prefix_v1(None, cg, flagged=done, days=days)
    return vt.unionByName(t2).unionByName(rp).select(*V1_COLUMNS)
