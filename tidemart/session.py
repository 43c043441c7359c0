"""Session defaults and the shared scratch location.

Everything the library writes for its own bookkeeping (staged extracts,
versioned table images, streaming checkpoints) goes under the cluster's
shared checkpoint folder, read from the session. Only when that setting is
missing (local tests) does the library pick a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed defaults for this pipeline. Dates are UTC days everywhere.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Listing thousands of day folders: a bounded number of listing tasks
    # (the default starts one task per folder).
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


# Sizing for a large cluster (shared storage, 100s-1000s of executors).
# Partitions are sized so that a shuffle partition and a scan split stay a
# few hundred MB -- far below executor memory, so sorts and hash tables spill
# rarely; AQE then coalesces small partitions and splits skewed ones.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(largest_shuffle_bytes: int, executor_cores_total: int) -> dict[str, str]:
    """Spark settings for a cluster run, sized from the largest shuffle.

    ``spark.sql.shuffle.partitions`` is the initial partition count AQE
    starts from: enough for ``largest_shuffle_bytes`` at about 256 MB per
    partition, and at least two waves of the cluster's cores.
    """
    partitions = max(2 * executor_cores_total,
                     -(-largest_shuffle_bytes // TARGET_PARTITION_BYTES))
    return {
        **{k: v for k, v in SESSION_DEFAULTS.items() if not k.startswith("spark.ui.show")},
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(TARGET_PARTITION_BYTES),
        # Static broadcast only from file statistics of small tables; AQE may
        # still switch a join to broadcast from measured shuffle sizes.
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(executor_cores_total),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemart", extra: dict | None = None) -> SparkSession:
    """SparkSession with the pipeline's defaults (used by tests and bench)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Small local inputs: let AQE keep a partition per core instead of
    # merging everything below 1 MB into one or two tasks.
    conf.setdefault("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    if master.startswith("local["):  # local sessions keep managed tables out of the working directory
        conf.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemart-warehouse-"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every
    executor. Only when it is unset (local runs, tests) is a folder of our
    own created and registered.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemart-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}tidemart/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that look at local files)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
