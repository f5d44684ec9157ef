"""Session helpers: a local session for tests/bench and the shared scratch area."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every editflow job relies on.  The time zone matters because
# ``event_timestamp`` is rendered as text in the session time zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "editflow") -> SparkSession:
    """Single-JVM session used by tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("EDITFLOW_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; it is
    read from the session, never invented.  Only a local-mode session without
    one (tests) gets a fresh directory in its warehouse, which goes with the session.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running editflow jobs")
    scratch = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{uuid.uuid4().hex[:12]}"
    spark.sparkContext.setCheckpointDir(scratch)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/editflow/{purpose}-{uuid.uuid4().hex[:12]}"
