"""SparkSession helpers.

Production jobs receive a session from the cluster and only call
:func:`ensure_checkpoint_dir`.  Tests and the benchmark build a local one with
:func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on; applied by local_session and checked by
# tune_session (which never overrides what the cluster already set).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only small, checked sides: the Catalyst size estimate is the
    # gate (10 MB default); the library adds explicit hints only for sides with
    # a proven row bound (1-row control frames, code maps, model thresholds).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rumbo", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, ANSI, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RUMBO_DRIVER_MEMORY", "8g"))
        # small local inputs: let a few-MB table still split over every core
        .config("spark.sql.files.openCostInBytes", str(1024 * 1024))
        # no Python call-site capture per Column call (error context only);
        # it costs a JVM round trip per function call while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", os.environ.get("RUMBO_DF_DEBUG", "false"))
        # checkpointed triggers are removed once their frames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply RECOMMENDED_CONF on an existing session where a value is unset."""
    for k, v in RECOMMENDED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared folder set by the platform and is only read.
    When it is unset a local session (tests) gets a fresh scratch folder; on any
    other master this is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rumbo-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
