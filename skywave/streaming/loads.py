"""Batch loads of source files in which a re-load replaces.

A collector may rewrite a file under its name.  Bronze rows therefore carry the
file they come from and the version of the load that read them:

* ``load_pending`` lists the folder, takes the files that the log doesn't have, or
  has with another size or modification time, and reads them into one new version.
* The log's entries of that version are written last.  They are what makes the
  load visible: a load that fails before leaves a folder that the next one, which
  gets the same version, overwrites.
* ``read_current`` gives each file's rows of its newest logged version: versions
  after the last logged one are pruned as partitions, and the entries that a later
  load replaced (few: files that have been rewritten) are an anti join.

A rewritten file without rows is logged with 0 rows and hides its older ones (files
of zero bytes aren't listed by Spark; an empty gzip file has some).
"""

from __future__ import annotations

import socket
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skywave.sources import schemas
from skywave.streaming.ingest import JSON_TS_FORMAT

LOG = ("file_path string, file_size long, file_modified timestamp, row_count long, loaded_at timestamp, elapsed_ms long, "
       "hostname string, load_version long")


def listing(spark: SparkSession, source_dir: str) -> DataFrame:
    """(file_path, file_size, file_modified) of the folder; contents are not read."""
    m = F.col("_metadata")
    return spark.read.format("binaryFile").load(source_dir).select(
        m["file_path"].alias("file_path"), m["file_size"].alias("file_size"), m["file_modification_time"].alias("file_modified"))


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All entries; none if nothing has been loaded yet."""
    try:
        return spark.read.schema(LOG).parquet(log_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def newest_entries(log: DataFrame) -> DataFrame:
    """Each file's entry of its last load."""
    last = Window.partitionBy("file_path").orderBy(F.desc("load_version"))
    return log.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def changed_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files that have never been loaded, or that have changed since."""
    done = newest_entries(log).select(*[F.col(c).alias(f"__{c}") for c in ("file_path", "file_size", "file_modified")])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("file_path", "file_size", "file_modified")]
    return files.join(done, same[0] & same[1] & same[2], "left_anti")


def load_pending(spark: SparkSession, source_dir: str, bronze_path: str, log_path: str, schema=schemas.PSKR_SPOT,
                 max_files: int = 10_000, ts_col: str = "timestamp") -> int:
    """Loads what is pending, ``max_files`` (whose names the reader is given) to a
    version; returns the number of files loaded."""
    loaded = 0
    while True:
        log = read_log(spark, log_path)
        # names only: as many as one load reads
        files = changed_files(listing(spark, source_dir), log).orderBy("file_path").limit(max_files).collect()
        if not files:
            return loaded
        version = (log.agg(F.max("load_version")).first()[0] or 0) + 1
        _load(spark, [tuple(f) for f in files], version, bronze_path, log_path, schema, ts_col)
        loaded += len(files)


def _load(spark: SparkSession, files: list[tuple], version: int, bronze_path: str, log_path: str, schema, ts_col: str) -> None:
    began = time.time()
    rows = (spark.read.schema(schema).option("timestampFormat", JSON_TS_FORMAT).json([f[0] for f in files])
            .withColumn("file_path", F.col("_metadata.file_path")).withColumn("ym", F.date_format(ts_col, "yyyyMM").cast("int")))
    target = f"{bronze_path}/load_version={version}"
    rows.hint("rebalance", "ym").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ym").parquet(target)
    counts = spark.read.schema("file_path string").parquet(target).groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"))
    listed = spark.createDataFrame(files, "file_path string, file_size long, file_modified timestamp")
    entries = listed.join(counts, "file_path", "left").select(
        "file_path", "file_size", "file_modified", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"), F.current_timestamp().alias("loaded_at"),
        F.lit(int((time.time() - began) * 1000)).cast("long").alias("elapsed_ms"), F.lit(socket.gethostname()).alias("hostname"))
    entries.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{log_path}/load_version={version}")


def replaced(log: DataFrame) -> DataFrame:
    """(file_path, load_version) of entries that a later load of the file replaced."""
    later = Window.partitionBy("file_path")
    return (log.withColumn("__last", F.max("load_version").over(later)).where("load_version < __last")
               .select("file_path", "load_version"))


def read_current(spark: SparkSession, bronze_path: str, log_path: str, schema=schemas.PSKR_SPOT) -> DataFrame:
    """Bronze as the files were when they were last loaded."""
    log = read_log(spark, log_path)
    last = log.agg(F.max("load_version")).first()[0]
    names = [f.name for f in schema.fields]
    if last is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(_bronze_schema(schema)).parquet(bronze_path).where(F.col("load_version") <= last)
    return rows.join(replaced(log), ["file_path", "load_version"], "left_anti").select(*names)


def _bronze_schema(schema):
    from pyspark.sql import types as T
    return T.StructType([*schema.fields, T.StructField("file_path", T.StringType()), T.StructField("load_version", T.LongType()),
                         T.StructField("ym", T.IntegerType())])


def write_named_files(df: DataFrame, target: str, name: str = "file") -> None:
    """One gzip JSON file for each value of column ``name`` (a string), under that name:
    how a collector writes, and rewrites, its files (fixture / export helper).  The
    files are written beside the target and moved there one by one."""
    spark = df.sparkSession
    staged = f"{target.rstrip('/')}-staged-{int(time.time() * 1e6)}"
    df.repartition(name).write.partitionBy(name).option("compression", "gzip").option("timestampFormat", JSON_TS_FORMAT).json(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    for folder in fs.globStatus(path(f"{staged}/{name}=*")):
        for part in fs.globStatus(path(f"{folder.getPath()}/part-*")):
            to = path(f"{target}/{folder.getPath().getName().split('=', 1)[1]}.json.gz")
            fs.delete(to, False)
            fs.rename(part.getPath(), to)
