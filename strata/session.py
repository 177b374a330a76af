"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Session settings every job relies on. The session zone is pinned so that
# timestamp text without an offset always means the same instant (D8).
#
# Broadcasts: the static planner's threshold is switched off because it acts
# on *estimated* sizes, which after explode, JSON parsing and aggregation can
# be far too low; a wrong static broadcast of a large side fails the job.
# Adaptive execution still turns a join into a broadcast join when the
# materialized shuffle of one side is measured below its own threshold, so a
# side is only broadcast with a proven size bound.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Streaming dedupe state grows with the key space: keep it in RocksDB
    # (off-heap, checkpointed incrementally) rather than on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

# Spark's own setting: a finished execution gives its shuffle files back.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, app_name: str = "strata",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. A temporary folder is registered only when nothing
    is configured *and* the session is a plain ``local`` master, where driver
    and tasks are one process on one disk; on a cluster an unset folder is an
    error, because each executor would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root for one job's outputs.

    Only the name is made; Spark's writers create the folder on whatever file
    system the root is on.
    """
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application: Python
    workers import it by name, wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("strata", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
