"""Incremental rollups kept by Structured Streaming, lossless for any file order.

Like the source's insert-triggered views, a rollup counts every row whenever it
arrives: there is no watermark, so no row is ever too late.  Each micro-batch is
reduced to mergeable partials (counts and sums per key; for distinct stations
the distinct stations themselves) which are written under its batch id, so a
replayed batch replaces its own output.

Reading sums the partials.  So that a reader doesn't meet every batch ever run, the
stream itself compacts: at the start of batch b, a multiple of ``compact_every``, it
merges the last compacted set and the batches since into the set ``upto = b - 1``.
Those batches are done (b runs only then), so none of them is replayed later.  A
one-row manifest file of the set is written after the set, and readers take the
set of the newest manifest and the batches after it (pruned as partitions): the
switch is atomic, a set without a manifest is as if it weren't there, and a
replayed compaction writes the same set again.  A reader meets one set and fewer
than 2 ``compact_every`` batches.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave.operators.features import with_quality_bucket
from skywave.sources import schemas

QUALITY_KEYS = ["hour_start", "band", "quality_bucket"]
DAILY_KEYS = ["day", "band", "mode"]


COMPACT_EVERY = 100


def _run(stream: DataFrame, partials, checkpoint: str, available_now: bool, compact_every: int = COMPACT_EVERY):
    """partials: {path: (function of a micro-batch, function that merges partials)},
    each batch's written under its id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            for path, (_, merge) in partials.items():
                compact(batch.sparkSession, path, merge, batch_id - 1)
        batch.persist()                       # read once for all partials of the batch
        for path, (reduce, _) in partials.items():
            (reduce(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/batches"))
        batch.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def compacted_upto(spark: SparkSession, path: str) -> int:
    """The last batch of the newest compacted set that readers see, -1 if none."""
    try:
        return spark.read.schema("upto long").parquet(f"{path}/manifest").agg(F.max("upto")).first()[0]
    except AnalysisException as missing:      # nothing has been compacted yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The newest compacted set and the batches after it."""
    upto = compacted_upto(spark, path)
    new = spark.read.parquet(f"{path}/batches").where(F.col("batch_id") > upto).drop("batch_id")
    return new if upto < 0 else new.unionByName(spark.read.parquet(f"{path}/compacted/upto={upto}"))


def compact(spark: SparkSession, path: str, merge, upto: int) -> None:
    """Merges what readers see, batches up to ``upto``, into one set and switches to it."""
    old = compacted_upto(spark, path)
    if old >= upto:                           # done already: a replay
        return
    batches = spark.read.parquet(f"{path}/batches").where((F.col("batch_id") > old) & (F.col("batch_id") <= upto)).drop("batch_id")
    if old >= 0:
        batches = batches.unionByName(spark.read.parquet(f"{path}/compacted/upto={old}"))
    merge(batches).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/compacted/upto={upto}")
    switch(spark, path, upto)


def switch(spark: SparkSession, path: str, upto: int) -> None:
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def quality_partials(silver: DataFrame) -> DataFrame:
    return (with_quality_bucket(silver)
            .groupBy(F.date_trunc("hour", "timestamp").alias("hour_start"), "band", "quality_bucket")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("distance").alias("sum_distance"), F.sum("kp_index").alias("sum_kp")))


def merge_quality(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*QUALITY_KEYS).agg(*[F.sum(c).alias(c) for c in ("count", "sum_distance", "sum_kp")])


def run_quality_rollup(spark: SparkSession, silver_dir: str, schema, out_path: str, checkpoint: str,
                       available_now: bool = True, max_files_per_trigger: int = 1000, compact_every: int = COMPACT_EVERY):
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(silver_dir)
    return _run(src, {out_path: (quality_partials, merge_quality)}, checkpoint, available_now, compact_every)


def read_quality_rollup(spark: SparkSession, out_path: str) -> DataFrame:
    return (merge_quality(read_partials(spark, out_path))
            .withColumn("avg_distance", F.col("sum_distance") / F.col("count"))
            .withColumn("avg_kp", F.col("sum_kp") / F.col("count")))


def daily_partials(spots: DataFrame) -> DataFrame:
    """Per day, band and mode: spots, sum of SNR, longest path."""
    return (spots.groupBy(F.to_date("timestamp").alias("day"), "band", "mode")
            .agg(F.count(F.lit(1)).alias("spot_count"), F.sum("snr").alias("sum_snr"), F.max("distance").alias("max_distance")))


def daily_stations(spots: DataFrame) -> DataFrame:
    """The distinct stations of each day, band and mode, by side."""
    sides = F.array(F.struct(F.lit("tx").alias("side"), F.col("callsign").alias("call")),
                    F.struct(F.lit("rx").alias("side"), F.col("reporter").alias("call")))
    return (spots.select(F.to_date("timestamp").alias("day"), "band", "mode", F.explode(sides).alias("s"))
            .select(*DAILY_KEYS, "s.*").distinct())


#: log2 of a sketch's registers: a standard error of about 1.04 / sqrt(4096) = 1.6 %.
SKETCH_LOG2 = 12


def daily_sketches(spots: DataFrame) -> DataFrame:
    """Per day, band and mode: sketches of the distinct transmitters and receivers, a
    few KB each however many stations there are."""
    return spots.groupBy(F.to_date("timestamp").alias("day"), "band", "mode").agg(
        F.hll_sketch_agg("callsign", SKETCH_LOG2).alias("tx_sketch"), F.hll_sketch_agg("reporter", SKETCH_LOG2).alias("rx_sketch"))


def merge_sketches(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*DAILY_KEYS).agg(F.hll_union_agg("tx_sketch").alias("tx_sketch"), F.hll_union_agg("rx_sketch").alias("rx_sketch"))


def run_spots_daily(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, available_now: bool = True,
                    max_files_per_trigger: int = 1000, compact_every: int = COMPACT_EVERY, sketches: bool = False):
    """Daily rollup of spots: counts and distinct stations, as partials under out_path.
    With ``sketches`` the stations are mergeable sketches instead of the stations
    themselves: a bounded size per key, and approximate counts."""
    src = spark.readStream.schema(schemas.WSPR_SPOT).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    stations = {f"{out_path}/sketches": (daily_sketches, merge_sketches)} if sketches else {f"{out_path}/stations": (daily_stations, DataFrame.distinct)}
    partials = {f"{out_path}/counts": (daily_partials, merge_daily)} | stations
    return _run(src, partials, checkpoint, available_now, compact_every)


def merge_daily(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*DAILY_KEYS).agg(F.sum("spot_count").alias("spot_count"), F.sum("sum_snr").alias("sum_snr"),
                                             F.max("max_distance").alias("max_distance"))


def read_spots_daily(spark: SparkSession, out_path: str, sketches: bool = False) -> DataFrame:
    """Same columns as ``reports.spots_daily``; distinct counts are exact, or with
    ``sketches`` estimated."""
    counts = merge_daily(read_partials(spark, f"{out_path}/counts"))
    if sketches:
        unique = merge_sketches(read_partials(spark, f"{out_path}/sketches")).select(
            *DAILY_KEYS, F.hll_sketch_estimate("tx_sketch").alias("unique_tx"), F.hll_sketch_estimate("rx_sketch").alias("unique_rx"))
    else:
        stations = read_partials(spark, f"{out_path}/stations").select(*DAILY_KEYS, "side", "call").distinct()
        unique = stations.groupBy(*DAILY_KEYS).agg(F.count_if(F.col("side") == "tx").alias("unique_tx"),
                                                   F.count_if(F.col("side") == "rx").alias("unique_rx"))
    on = [counts[k].eqNullSafe(unique[k]) for k in DAILY_KEYS]
    return counts.join(unique, on).select(
        *[counts[k] for k in DAILY_KEYS], "spot_count", "unique_tx", "unique_rx",
        (F.col("sum_snr") / F.col("spot_count")).alias("avg_snr"), "max_distance")
