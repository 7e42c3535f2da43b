"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC calendar semantics (hour/month/date of a
# spot are UTC in the reference), AQE for runtime re-planning (coalescing,
# skew-join splitting, broadcast conversion) and Arrow for pandas transfers.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Exact percentile buffers hold at most a few hundred (value, count) pairs
    # (SNR is a small integer); keep up to 16K groups per task in the hash map
    # before the sort-based fallback (~32 MB worst case per task).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    # Top-k: each task keeps its own k best rows of a group before the exchange, up
    # to this k (sampling.top_k finds the rows of larger samples by counts).
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
    # Checkpointed intermediates are deleted once no plan references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "skywave", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_root(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone; every hour/month/date in the model is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates and stream state.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage every executor can reach).  Only when the session has none, as in
    local tests, a fresh scratch folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS / object storage): "
                               "skywave writes intermediate tables and stream state there")
        root = tempfile.mkdtemp(prefix="skywave-ckpt-")      # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/skywave/{name}-{uuid.uuid4().hex[:12]}"
