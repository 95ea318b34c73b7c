"""Spark session construction and shared-storage helpers.

Every setting that changes results is pinned here (time zone) and every setting
that only changes speed has a scale-aware default that a cluster deployment can
override through ``extra``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "threatlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    ``master`` is set only when given (or in ``SPARK_MASTER``), so
    ``spark-submit --master yarn`` keeps working.  Shuffle partitions default to
    the Spark default; AQE coalesces them at run time, so a generous number is
    safe at 100 TB and cheap at test scale.
    """
    builder = SparkSession.builder.appName(app_name)
    # only an explicit master is set: under spark-submit the cluster's master stays in
    # force, and a plain ``python`` launch defaults to local[*] by itself
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    conf = {
        # Results depend on wall-clock conversions only through this setting.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # checkpoint files of garbage-collected plans are removed from shared storage
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting it on the context if needed.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is always
    used.  Only a local session without the setting (unit tests) gets a private
    temporary directory; a cluster session without it is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        try:
            configured = spark.conf.get(CHECKPOINT_CONF)
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not is_local(spark):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS, S3, ...)")
        configured = tempfile.mkdtemp(prefix="threatlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory.

    Used for round trips (snapshots, document exports) so that every executor sees
    the same files.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/threatlens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(
    input_bytes: int,
    executors: int,
    cores_per_executor: int = 4,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Settings sized for a cluster run (pass them as ``build_session(extra=...)``).

    * scan splits of ``target_partition_bytes`` (parquet row groups permitting);
    * shuffle partitions so that one partition holds about that much data, and at
      least three waves of tasks; AQE coalesces small ones and splits skewed ones;
    * skew: a partition is skewed at 4x the median and above 1 GB;
    * static broadcast stays at the 10 MB default — the operators broadcast only
      sides bounded by construction.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(3 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    }
