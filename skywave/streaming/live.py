"""Live solar conditions: a snapshot table refreshed by a stream, and
enrichment of streaming spots with the conditions of their time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave.operators.features import conditions_by_bucket, enrich_with_conditions, live_conditions
from skywave.sources import schemas


def run_live_conditions(spark: SparkSession, solar_dir: str, snapshot_path: str, checkpoint: str,
                        available_now: bool = True, max_files_per_trigger: int = 1000):
    """Each micro-batch writes its newest reading under its batch id: one row a
    batch, replaced on replay.  The current state is the newest of these
    (``read_live_conditions``), so a batch of old readings that arrives late
    changes nothing, and a reader never meets an empty folder."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        (newest_reading(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(snapshot_path))

    w = (spark.readStream.schema(schemas.SOLAR).option("maxFilesPerTrigger", max_files_per_trigger).parquet(solar_dir)
         .writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def newest_reading(solar: DataFrame) -> DataFrame:
    return solar.orderBy(F.col("time").desc(), F.col("updated_at").desc()).limit(1)


def read_live_conditions(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """The newest reading of all batches, with its label: one row."""
    return live_conditions(spark.read.parquet(snapshot_path).drop("batch_id"))


def enrich_stream(spots_stream: DataFrame, solar: DataFrame) -> DataFrame:
    """Stream-static join: streaming spots x per-bucket conditions (static side
    re-read every micro-batch)."""
    return enrich_with_conditions(spots_stream, conditions_by_bucket(solar))
