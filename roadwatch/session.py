"""Session helpers.

Operators never create a session; only entry points (tests, bench, jobs) do.
The settings here are the ones every job relies on: UTC session time (the
millisecond epoch columns and DuckDB agree only in UTC), adaptive execution
with skew-join splitting, and no web UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings a streaming program applies to its session. The number of state
# partitions is fixed in a query's checkpoint, and every stateful operator has
# that many stores: it follows the cores, not the size of a batch shuffle.
STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for the target deployment: ~1000 executors reading ~100 TB of
# passages. Scan tasks of 1 GB give ~100,000 splits and the shuffles start at
# 16,000 reducers: 1.6e9 blocks of ~20 KB for a 30 TB shuffle, which the driver's
# map status and the disks can carry (100,000 reducers would make blocks of
# 3 KB), ~2 GB per reducer, sorted with spill; AQE coalesces small ones towards
# 256 MB and splits any reducer above 1 GB that feeds a join.
# Broadcasts chosen at run time are capped at 64 MB per table.
SCALE_CONF = {
    "spark.sql.files.maxPartitionBytes": str(1024 ** 3),
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 ** 3),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
}


def apply_scale_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply :data:`SCALE_CONF` (SQL settings only; executor sizing stays with the
    deployment) to an existing cluster session."""
    for k, v in {**SCALE_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "roadwatch", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the deployment's own session is used instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf:
        # Tests only: the cluster names its shared folder itself.
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(
            prefix="roadwatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local session without the setting (tests) gets
    a scratch folder of its own. On a cluster that would be each machine's own
    disk, so there the setting is required.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="roadwatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (stream checkpoints, staged tables)."""
    return checkpoint_root(spark).rstrip("/") + "/" + name
