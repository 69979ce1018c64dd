"""Session construction and shared-storage helpers.

Everything in the package takes a ``SparkSession`` from the caller; this
module only offers a builder with sensible defaults for tests and the bench,
and a way to find the cluster-shared folder for checkpoints and written
tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot keys also where the next join needs the same partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of materialized intermediates are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(executors: int, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB).

    Start with many shuffle partitions and let AQE coalesce them to
    ~256 MB; keep scan splits at 256 MB; let AQE split skewed join
    partitions and convert joins to broadcast only below 64 MB of measured
    size.  ``spark.checkpoint.dir`` must name shared storage and is left to
    the deployment.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(max(200, 3 * cores)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(
    master: str = "local[*]",
    app_name: str = "cataloom",
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE, UTC and the UI off."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        ensure_checkpoint_dir(spark, default=checkpoint_dir)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster-shared folder named by ``spark.checkpoint.dir``, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_value:
        spark.sparkContext.setCheckpointDir(conf_value)
        return spark.sparkContext.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is.  When it is unset the given default is used, and without one, on a
    local master only, a folder under ``spark.sql.warehouse.dir``; on a cluster
    that is an error, since executors would not see a folder chosen here.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    if not default and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    target = default or os.path.join(_warehouse(spark), "_checkpoints")
    spark.sparkContext.setCheckpointDir(target)
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path inside shared storage for written tables and models."""
    base = ensure_checkpoint_dir(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return os.path.join(base, "tables", *leaf)


def _warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir")


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the checkpoint, not the
    whole plan) and makes the result a plain scan, so a join on it is a
    shuffle-against-shuffle join that AQE can split when a key is skewed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
