"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidepool") -> SparkSession:
    """Local/test session. On a cluster the submitted session is used as is."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("TIDEPOOL_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a ``local`` master without the setting gets a folder of this machine, removed at exit; on a cluster the
    setting is required, for executors cannot read the driver's disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session: the server's setting rules
        sc = None
    d = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc is not None else None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint dir (stream checkpoints, sinks, cut lineage)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
