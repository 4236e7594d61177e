"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Partition values stay text ('01' never becomes 1); adaptive execution splits
# hot shuffle partitions and sizes the rest at run time. Unions are not planned by
# partition: Spark 4.1 may fail on that when adaptive execution coalesces their
# inputs differently.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Aimed size of a shuffle partition, before and after adaptive coalescing.
PARTITION_BYTES = 256 * 2**20


def sized(shuffled_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffled_bytes``.

    Shuffles start with enough partitions to fit one in a task's memory, at
    least a few per core; adaptive execution joins small neighbours again.
    """
    partitions = max(math.ceil(shuffled_bytes / partition_bytes), 3 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(app_name: str = "lakeferry", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session on one machine (master ``local``) that names none gets a temporary
    folder; on a cluster that folder would be another one on every executor, so
    there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not one_machine(spark):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="lakeferry-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses; not created yet."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
