"""Session construction and shared-storage locations.

Jobs never pick a machine-local folder on a cluster: every path a job
writes (tables, streaming checkpoints, lineage cuts) hangs off the shared
folder named by ``spark.checkpoint.dir``.  Only when that setting is
absent (unit tests, a laptop) a scratch folder is created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Keeps streaming state off the JVM heap.
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Whether RocksDB counts the rows of a state.
STATE_ROWS_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def build_session(
    master: str | None = None,
    app_name: str = "cardsentry",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        STATE_PROVIDER_KEY: STATE_PROVIDER,
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> None:
    """Event time is UTC text on the wire; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session; if unset (tests,
    local runs) a fresh scratch folder is registered as the checkpoint
    directory so ``DataFrame.checkpoint()`` and our tables agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        raise ValueError(
            "spark.checkpoint.dir is unset: name a shared folder for checkpoints and tables"
        ) from None
    root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is unset: name a shared folder for checkpoints and tables"
            )
        root = tempfile.mkdtemp(prefix="cardsentry-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def default_parallelism(spark: SparkSession) -> int:
    """Total cores of the cluster (falls back to the configured default)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return int(spark.conf.get("spark.default.parallelism", None) or
                   spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file checks in tests."""
    if path.startswith("file:"):
        path = path[len("file:") :]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
