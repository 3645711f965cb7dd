"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings we want unless the cluster already chose something else.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # when no frame refers to them any more
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tillroll",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build a session with our defaults, or reuse the active one.

    A running session keeps every setting it has, its time zone too; only
    settings it lacks are added. On a cluster call it without ``master``: the
    launcher decides.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        for k, v in (extra or {}).items():
            if running.conf.get(k, None) is None and running.conf.isModifiable(k):
                running.conf.set(k, v)
        for k, v in DEFAULTS.items():
            if running.conf.get(k, None) is None and running.conf.isModifiable(k):
                running.conf.set(k, v)
        ensure_checkpoint_dir(running)
        return running
    builder = SparkSession.builder.appName(app_name)
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
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    is used as is. Only a local-mode session without one (tests) gets a
    fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, inside the checkpoint dir."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
