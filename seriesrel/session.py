"""Session helpers.

Operators never create a session: callers pass DataFrames in. These helpers
only build a session for scripts and tests, and find the shared scratch folder
that jobs use to cut lineage or land intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Connector packages used when the jars are on the classpath (cluster deploys).
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13"
JDBC_PACKAGE = "org.postgresql:postgresql"


def build_session(
    master: str | None = None,
    app_name: str = "seriesrel",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    packages: list[str] | None = None,
) -> SparkSession:
    """Build (or get) a session with the settings every job here relies on.

    UTC session time, AQE with partition coalescing and skew-join splitting,
    and no web UI. ``shuffle_partitions`` defaults to 2x the local cores in
    local mode; on a cluster leave it to the deploy config (AQE coalesces).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = 2 * (os.cpu_count() or 4)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if packages:   # e.g. f"{KAFKA_PACKAGE}:<spark version>" on a cluster with a repository
        conf["spark.jars.packages"] = ",".join(packages)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(total_cores: int, *, scan_split_mb: int = 512,
                 advisory_mb: int = 256) -> dict[str, str]:
    """Settings for large clusters (pass as ``build_session(extra=...)``).

    * scan splits of ``scan_split_mb`` (100 TB / 512 MB ~ 200k tasks instead of
      800k at the 128 MB default);
    * shuffle width 4x the cores as the *upper* bound: AQE coalesces small
      shuffles (the per-day aggregates here are tiny) towards
      ``advisory_mb`` and splits skewed join partitions;
    * the broadcast threshold stays at Spark's default: only sides measured
      small (statically or by AQE at runtime) are broadcast.
    """
    return {
        "spark.sql.files.maxPartitionBytes": f"{scan_split_mb}m",
        "spark.sql.shuffle.partitions": str(4 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * advisory_mb}m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set (a shared filesystem path); we never
    invent a machine-local folder there. Only in local mode, where it is
    unset, a folder under the system temp dir is created and registered.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder "
                "(HDFS/S3/ABFS) before running seriesrel jobs on a cluster")
        base = tempfile.mkdtemp(prefix="seriesrel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one job's tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/seriesrel/{name}-{uuid.uuid4().hex[:12]}"
