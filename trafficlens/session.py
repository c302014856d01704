"""Spark session helpers.

The library never creates its own cluster settings on a real deployment:
``builder`` only fills in values that are unset, and the checkpoint folder
comes from ``spark.checkpoint.dir`` as the cluster names it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. Applied only where the session has no value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.exchange.reuse": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # merge streaming session windows inside each task before the shuffle, so
    # a heavy user is not shipped hit by hit
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Static settings (only at session start): remove checkpoint files of
# DataFrames that are no longer referenced.
STATIC = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "trafficlens",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster).
    ``event_log_dir`` writes Spark's event log there (stage and task times
    can then be read offline; the web UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TRAFFICLENS_DRIVER_MEMORY", "16g"))
    )
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in {**DEFAULTS, **STATIC}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set runtime SQL defaults the cluster left unset."""
    for k, v in DEFAULTS.items():
        if k in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            continue
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) without one gets a scratch folder; on a
    cluster a machine-local folder would not survive the loss of that
    machine, so an unset ``spark.checkpoint.dir`` is an error there."""
    d = checkpoint_dir(spark)
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    d = tempfile.mkdtemp(prefix="trafficlens-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Write a small intermediate result once to the shared checkpoint folder
    (reliable ``checkpoint``) and return a DataFrame reading it. Used where
    several subqueries derive from one aggregate, so the source is scanned
    and shuffled once; it also cuts the lineage for recovery."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
