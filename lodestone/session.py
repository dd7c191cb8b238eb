"""Session construction and the shared folder for materialised frames."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Lets AQE keep more (smaller) tasks for small rebalanced day-partitioned
    # writes, where the per-file cost dominates; no effect on large data.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "lodestone", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster the submitter sets master and sizes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only when the session names none (local tests) a private folder is made
    and registered, so ``DataFrame.checkpoint()`` works everywhere.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the server owns the setting
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_uuid(current.rsplit("/", 1)[-1]) else current
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lodestone-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root, for tables written by a job."""
    root = shared_root(spark)
    return os.path.join(root, "lodestone", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Reliable checkpoint into the shared folder (``spark.checkpoint.dir``):
    cuts lineage, survives executor loss, and is computed once. The frame is
    persisted first, because an eager reliable checkpoint otherwise runs the
    plan twice (once to count, once to write the checkpoint files)."""
    from pyspark import StorageLevel

    shared_root(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist(blocking=False)
    return out


def _is_uuid(s: str) -> bool:
    try:
        uuid.UUID(s)
        return True
    except ValueError:
        return False


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy per-row stages at least one task per core.

    A scan gets one task per file split; a single small file (one row group)
    is one task, and everything narrow after it runs on one core. Below the
    cluster's parallelism the rows are dealt round-robin to that many
    partitions; a large input (thousands of splits) is returned unchanged,
    so at scale this adds no shuffle.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # no RDD API (Spark Connect): leave the plan as it is
        return df
    return df.repartition(target) if n < target else df
