"""Session helpers: sane defaults for local tests, nothing that overrides a cluster.

On a cluster the session is created by the platform; we only *read* its settings.
`ensure_checkpoint_dir` sets a checkpoint folder only when none is configured (tests,
local runs), and every scratch path the library writes goes under that shared folder,
never a machine-local temporary directory chosen behind the caller's back.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make the plans below behave well at scale. They are only applied by
# `local_session`; a cluster session keeps whatever its owner configured.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g")))
    for k, v in {**SCALE_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    if "spark.sql.warehouse.dir" not in (extra or {}):
        # local runs only: a fresh warehouse folder instead of ./spark-warehouse
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-wh-", dir="/tmp"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder; set a fresh local one only if unset."""
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-scratch/{name}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete what `scratch_path` handed out under the checkpoint folder (through Spark's file
    system, so also on a remote store). Call it when no result that reads from it is needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-scratch")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scale_conf(total_cores: int, input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized from the cluster and the input, for `spark-submit --conf` or
    `spark.conf.set` before a job: enough initial shuffle partitions that each fits in
    executor memory (AQE then coalesces small ones and splits skewed ones), scan splits
    of `partition_bytes`, and the same advisory size for AQE."""
    by_size = -(-input_bytes // partition_bytes)
    initial = max(2 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }
