"""SparkSession factory and session-level helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that are part of the semantics of the models (not tuning):
# timestamps are interpreted in UTC, ANSI arithmetic is on (so every
# division goes through ``safe_ratio`` and every dirty cast through
# ``try_cast``) and partition overwrite only replaces touched partitions.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Runtime tuning.  AQE re-plans joins from real sizes, coalesces small
# shuffle partitions and splits skewed ones; the broadcast threshold is
# a hard upper bound on what Spark may broadcast on its own.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Cluster profile for ~100 TB inputs on ~1000 executors.  Sizing rule: the
# largest shuffle (the line table reduced per order: roughly a third of its
# scanned bytes) divided by ~200 MB per partition gives the initial number of
# shuffle partitions; AQE coalesces what turns out smaller and splits skewed
# partitions above 5x the median and 512 MB.  Scan splits of 512 MB keep the
# task count of a 100 TB scan around 200k.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.speculation": "true",
    "spark.dynamicAllocation.enabled": "true",
    "spark.shuffle.service.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "peerscope",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Build (or fetch) a session with the semantic and tuning settings.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``); on a
    cluster pass ``profile="cluster"`` under spark-submit (the master comes
    from there) to apply ``CLUSTER_CONF``.  ``spark.checkpoint.dir`` must then
    name a shared folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and profile == "local" and "SPARK_MASTER" not in os.environ:
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    if master:
        builder = builder.master(master)
    conf = {**SEMANTIC_CONF, **TUNING_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_semantic_conf(spark: SparkSession) -> None:
    """Pin the semantic settings on an existing session (e.g. the driver's)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system or object store); it must be set there, because a folder on
    one machine does not survive the loss of that machine.  Only in local
    mode (tests, single-node runs) is a scratch folder created when unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        path = tempfile.mkdtemp(prefix="peerscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")
