"""Session settings shared by every entry point.

All jobs assume UTC wall-clock semantics (the reference parses every time
value to UTC), adaptive query execution for runtime re-planning and skew
splitting, and a checkpoint folder that the cluster names.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job needs at runtime; all are session-settable, so they are
# applied to whatever session the caller hands us as well.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows reach Python in batches of bounded bytes: 10,000 long texts at once
    # are held several times, by the executor and by the worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # MIN/MAX/COUNT answered from parquet footers (e.g. the next surrogate id).
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app: str = "obsengine",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.  The Spark UI stays off: jobs are non-interactive.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset (local tests) a folder is made: under
    ``fallback`` if given, else a fresh temporary folder in local mode; a
    cluster session without the setting is an error, never a machine-local
    folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if fallback is None:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is unset: a cluster job needs a shared folder"
            )
        fallback = tempfile.mkdtemp(prefix="obsengine-ckpt-")
    base = fallback
    os.makedirs(base, exist_ok=True)
    sc.setCheckpointDir(base)
    return base
