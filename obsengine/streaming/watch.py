"""Folder watcher: re-run a batch job whenever the folder's listing changes.

Spark's file stream source never re-reads a modified file and ignores
deletions, while the watcher must react to new, changed and removed files.
So the stream is driven by a ``rate`` source (one tick per trigger
interval); each micro-batch computes the folder signature, compares it with
the one stored beside the stream's checkpoint, and re-runs the job over the
whole folder when it differs (always on the first batch).  The stored
signature lives in the checkpoint folder, so a restarted watcher resumes
without a redundant run, and it is written only after the job succeeded.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.listing import snapshot_signature

# Fixed value that must equal the reference: default poll interval.
DEFAULT_POLL = "5 seconds"


def _stored(spark: SparkSession, path: str) -> str | None:
    try:
        rows = spark.read.text(path).collect()
    except AnalysisException:
        return None
    return rows[0]["value"] if rows else None


def _store(spark: SparkSession, path: str, value: str) -> None:
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def make_batch_fn(
    spark: SparkSession,
    folder: str,
    job: Callable[[], object],
    state_path: str,
    glob: str = "*.csv",
) -> Callable[[DataFrame, int], None]:
    """The per-tick function: run ``job`` when the folder signature changed."""

    def on_tick(_ticks: DataFrame, _batch_id: int) -> None:
        row = snapshot_signature(spark, folder, glob).first()
        sig = f"{row['signature']}|{row['n_files']}"
        if sig != _stored(spark, state_path):
            job()
            _store(spark, state_path, sig)

    return on_tick


def watch(
    spark: SparkSession,
    folder: str,
    job: Callable[[], object],
    checkpoint: str,
    poll: str = DEFAULT_POLL,
    glob: str = "*.csv",
    available_now: bool = False,
) -> StreamingQuery:
    """Start the watcher.  ``available_now=True`` runs a single tick and stops
    (tests, scheduled runs); otherwise it ticks every ``poll``."""
    state = posixpath.join(checkpoint, "signature")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = (
        ticks.writeStream.foreachBatch(make_batch_fn(spark, folder, job, state, glob))
        .option("checkpointLocation", posixpath.join(checkpoint, "stream"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    return writer.start()
