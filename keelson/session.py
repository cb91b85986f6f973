"""Session helpers.

Library functions never build or reconfigure a session; they take the one
they are given. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings the library's plans are designed around on a large cluster. The
# scratch area comes from the cluster's own spark.checkpoint.dir.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Start high and let AQE coalesce: shuffles here are mostly small
    # partial aggregates, but model preparation and global sorts are not.
    "spark.sql.shuffle.partitions": "4000",
    # 100 TB / 256 MB = ~400k scan tasks: large enough splits to keep task
    # overhead low, small enough to stream through codegen'd stages.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply ``CLUSTER_CONF`` (runtime SQL settings only) to a session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "keelson") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KEELSON_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch area.

    On a cluster this is ``spark.checkpoint.dir`` (a shared filesystem every
    executor can reach), read from the session. Only in local mode, and when
    the session has none — tests — a fresh directory under the system temp
    folder is created and registered as the checkpoint dir, so
    ``DataFrame.checkpoint()`` works as well. Elsewhere a missing setting is
    an error: executors would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        jsc = spark.sparkContext._jsc.sc()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        jsc = None
    if not configured and jsc is not None:
        current = jsc.getCheckpointDir()
        configured = current.get() if current.isDefined() else None
    if not configured:
        if jsc is None or not jsc.isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="keelson-ckpt-")
    if jsc is not None and jsc.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch area."""
    return f"{shared_dir(spark)}/keelson-{name}-{uuid.uuid4().hex[:12]}"
