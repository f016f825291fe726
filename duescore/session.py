"""Session settings and the shared folder for stage outputs.

On a cluster the session comes from the platform; ``get_session`` only fills
in settings that are not already set.  Stage outputs that cut lineage go to the
folder named by ``spark.checkpoint.dir`` (a shared file system on a cluster);
a local folder is chosen only when the session names none, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipelines are planned for.  AQE re-plans joins from runtime
# sizes (so a small side is broadcast only after Spark has measured it), splits
# skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # The creditor's persons are a selective side: let Spark build a runtime
    # bloom filter from them (bounded by maxNumBits) to prune the profile, debt
    # and event scans before their shuffles.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    # Feature rows are wide (over 100 columns); keep them in whole-stage codegen
    # (Spark still falls back per method when generated code grows too large).
    "spark.sql.codegen.maxFields": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Only for a single-machine session (tests, bench): tiny shuffles would otherwise
# be coalesced into one task.  On a cluster partitions are large and the
# cluster's advisory size governs coalescing.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # In local mode the driver JVM is the whole cluster: size its heap (only
    # takes effect when this builder starts the JVM).
    "spark.driver.memory": "8g",
}


def cluster_settings(largest_shuffle_bytes: int, target_partition_bytes: int = 128 << 20,
                     max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle sizing for a cluster run: start with enough partitions that the
    largest shuffle gets about ``target_partition_bytes`` per task (so tasks fit
    executor memory without spilling much) and let AQE coalesce smaller ones.

    For a 100 TB day whose widest shuffle (events or profile after pruning and
    partial aggregation) is about 5 TB, this gives 40,000 partitions.
    """
    n = max(200, min(max_partitions, -(-largest_shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "duescore") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    for k, v in conf.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    raise RuntimeError("spark.checkpoint.dir is not set; call ensure_checkpoint_dir in tests")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; only a single-machine session (tests)
    without one gets a local folder.  A cluster session must name a shared one."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (stage tables and checkpoints go there)")
        configured = tempfile.mkdtemp(prefix="duescore-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def stage_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for a written stage table."""
    return os.path.join(checkpoint_root(spark), "stages", *parts)
