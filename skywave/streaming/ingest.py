"""Incremental ingest of gzip JSONL spot files (PSK Reporter collector output).

The file source with a checkpoint gives exactly-once per file; every
micro-batch appends its rows to the month-partitioned bronze table and one
row per file to the ingest log (path, size, rows, load time, elapsed, host).
Both writes are keyed by the batch id, so a batch replayed after a failure
overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

import socket
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywave.operators.reports import ingest_log_latest
from skywave.sources import schemas

JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_files(df: DataFrame, path: str, files: int = 4, fmt: str = "json", newest_first: bool = False, ts_col: str = "timestamp") -> None:
    """Write ``df`` as files of consecutive event-time ranges, ``files`` at
    least, range after range -- the way a collector rotates its output -- or the
    last range first (fixture / export helper).  Every range is written by as
    many tasks as hold rows of it."""
    sec = F.unix_seconds(F.col(ts_col))
    lo, hi = df.agg(F.min(sec), F.max(sec)).first()
    step = max(1, (int(hi) - int(lo)) // files + 1)
    for i in sorted(range(files), reverse=newest_first):
        part = df.where((sec >= int(lo) + i * step) & (sec < int(lo) + (i + 1) * step))
        w = part.write.mode("append")
        if fmt == "json":
            w.option("compression", "gzip").option("timestampFormat", JSON_TS_FORMAT).json(path)
        else:
            w.parquet(path)


def write_jsonl_gz(df: DataFrame, path: str, files: int = 4) -> None:
    """Write rows as gzip-compressed JSON lines in event-time order."""
    write_files(df, path, files, "json")


def pskr_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of spots plus the file each row came from."""
    return (spark.readStream.schema(schemas.PSKR_SPOT).option("timestampFormat", JSON_TS_FORMAT)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir)
            .withColumn("file_path", F.col("_metadata.file_path"))
            .withColumn("file_size", F.col("_metadata.file_size")))


def ingest_pskr(spark: SparkSession, source_dir: str, bronze_path: str, log_path: str, checkpoint: str,
                available_now: bool = True, max_files_per_trigger: int = 1000):
    """Start (and with ``available_now`` run to completion) the ingest stream."""
    listed = source_files(spark, source_dir).persist() if available_now else None
    if listed is not None:
        listed.count()                        # the files that this run will have read at its end

    def load(batch: DataFrame, batch_id: int) -> None:
        t0 = time.time()
        rows = batch.withColumn("ym", F.date_format("timestamp", "yyyyMM").cast("int")).withColumn("batch_id", F.lit(batch_id)).persist()
        (rows.drop("file_path", "file_size").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id", "ym").parquet(bronze_path))
        elapsed = int((time.time() - t0) * 1000)
        per_file = rows.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("row_count"))
        (_log_rows(per_file, batch_id, elapsed)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log_path))
        rows.unpersist()

    w = (pskr_stream(spark, source_dir, max_files_per_trigger).writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
        _log_empty_files(spark, listed, log_path)
        listed.unpersist()
    return q


def source_files(spark: SparkSession, source_dir: str) -> DataFrame:
    """(file_path, file_size) of the folder; contents are not read."""
    return spark.read.format("binaryFile").load(source_dir).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))


def _log_rows(per_file: DataFrame, batch_id: int, elapsed: int) -> DataFrame:
    return per_file.select("file_path", F.col("file_size").cast("bigint"), F.col("row_count").cast("bigint"),
                           F.current_timestamp().alias("loaded_at"), F.lit(elapsed).cast("bigint").alias("elapsed_ms"),
                           F.lit(socket.gethostname()).alias("hostname"), F.lit(batch_id).alias("batch_id"))


def _log_empty_files(spark: SparkSession, listed: DataFrame, log_path: str) -> None:
    """Files that were read and held no row get an entry of 0 rows, under batch -1."""
    try:
        logged = spark.read.parquet(log_path).where("batch_id >= 0").select("file_path").distinct()
        empty = listed.join(logged, "file_path", "left_anti")
    except AnalysisException:                 # nothing has been logged yet
        empty = listed
    (_log_rows(empty.withColumn("row_count", F.lit(0)), -1, 0)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log_path))


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    return spark.read.parquet(bronze_path).select(*[f.name for f in schemas.PSKR_SPOT.fields])


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return ingest_log_latest(spark.read.parquet(log_path).drop("batch_id"))
