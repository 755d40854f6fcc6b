"""Session construction and the few cluster-level settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Session settings every job in this repo expects.  Timestamps are naive and
#: treated as UTC (reference convention), ANSI mode stays on, AQE re-plans
#: shuffles and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # files of a checkpoint go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Settings for a large cluster (about 100 TB of input, 1000 executors); pass
#: them as ``extra`` or in the submit configuration.  Shuffles start with many
#: partitions and AQE coalesces them to about ``advisoryPartitionSizeInBytes``
#: each, so a partition never has to hold more than a few hundred MB; skewed
#: join partitions above 5x the median (and 512 MB) are split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "50000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "guestfold", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF` applied.

    ``master`` and ``shuffle_partitions`` are only meant for local runs and
    tests; on a cluster they come from the submit configuration.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("GUESTFOLD_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings that can change on a live session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is used
    as is.  Only when it is unset on a local master (tests) a fresh scratch
    folder is created and registered; on a cluster an unset setting is an error,
    since executors can't share a machine's own folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="guestfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
