"""Callsign -> grid dimension and endpoint enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skywave.functions.grid import grid4, grid6, has_valid_field


def station_days(spots: DataFrame) -> DataFrame:
    """Compact summary of who was heard where and when: spot counts per
    (side, callsign, day, 6-char grid, valid_field), side 0 = transmitter
    (callsign, grid), 1 = receiver (reporter, reporter_grid).

    One scan of the bronze table with map-side aggregation; the callsign
    dimension, velocity days and type-2 telemetry all derive from it, so the
    fact table is read once for the whole flagging chain.  Grids without a
    valid field prefix are collapsed to '' (only their counts matter)."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("callsign").alias("cs"), F.col("grid").alias("g")),
        F.struct(F.lit(1).alias("side"), F.col("reporter").alias("cs"), F.col("reporter_grid").alias("g")),
    )
    valid = has_valid_field("g")
    return (spots.select(F.to_date("timestamp").alias("d"), F.inline(sides))
            .groupBy("side", F.col("cs").alias("callsign"), "d",
                     F.when(valid, grid6("g")).otherwise(F.lit("")).alias("grid6"), valid.alias("valid_field"))
            .agg(F.count(F.lit(1)).alias("n")))


def callsign_grid(spots: DataFrame | None = None, summary: DataFrame | None = None) -> DataFrame:
    """Every callsign's newest grid.

    Both endpoints of a spot are observations of a (callsign, grid) pair.  From
    the station-day summary (valid grids only): spots and last date per
    (side, callsign, 6-char grid), then per callsign the pair seen most recently
    (ties: the RX row, then more spots, then the smaller grid)."""
    summary = station_days(spots) if summary is None else summary
    pairs = (summary.where(F.col("valid_field"))
             .groupBy("side", "callsign", F.col("grid6").alias("grid"))
             .agg(F.sum("n").alias("spot_count"), F.max("d").alias("last_seen")))
    w = Window.partitionBy("callsign").orderBy(F.col("last_seen").desc(), F.col("side").desc(),
                                                F.col("spot_count").desc(), F.col("grid").asc())
    return (pairs.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("callsign", "grid", grid4("grid").alias("grid_4"), "spot_count", "last_seen"))


def callsign_grid_report(cg: DataFrame) -> DataFrame:
    return cg.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.countDistinct("callsign").alias("distinct_callsigns"),
                  F.count_if(F.col("spot_count") > 0).alias("rows_with_spots"))


def grid_dimension(cg: DataFrame) -> DataFrame:
    return cg.where(F.col("grid_4") != "").select("callsign", "grid_4")


def enrich_endpoints(df: DataFrame, cg: DataFrame, tx_col: str, rx_col: str) -> DataFrame:
    """Inner lookups of both endpoints in the callsign dimension; rows with an
    unresolved endpoint or an empty grid drop out.  Adds tx_grid_4, rx_grid_4.

    Plain joins: a stored dimension is broadcast if its files are small, a
    computed one if AQE finds it small; otherwise both lookups are sort-merge
    joins and AQE splits a skewed callsign."""
    dim = grid_dimension(cg)
    tx = dim.select(F.col("callsign").alias("__txc"), F.col("grid_4").alias("tx_grid_4"))
    rx = dim.select(F.col("callsign").alias("__rxc"), F.col("grid_4").alias("rx_grid_4"))
    return (df.join(tx, F.col(tx_col) == F.col("__txc"), "inner")
              .join(rx, F.col(rx_col) == F.col("__rxc"), "inner")
              .drop("__txc", "__rxc"))


def endpoint_resolution(df: DataFrame, cg: DataFrame, tx_col: str, rx_col: str, by=("band",)) -> DataFrame:
    """Share of rows (percent) whose both endpoints resolve to a grid, per group."""
    dim = grid_dimension(cg)
    tx = dim.select(F.col("callsign").alias("__txc"), F.lit(1).alias("__txok"))
    rx = dim.select(F.col("callsign").alias("__rxc"), F.lit(1).alias("__rxok"))
    j = (df.join(tx, F.col(tx_col) == F.col("__txc"), "left")
           .join(rx, F.col(rx_col) == F.col("__rxc"), "left"))
    both = F.col("__txok").isNotNull() & F.col("__rxok").isNotNull()
    return (j.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(both).alias("resolved"))
            .withColumn("resolved_pct", F.col("resolved") * 100.0 / F.col("rows")))
