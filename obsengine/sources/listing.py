"""Folder signature: a digest of the folder's file listing.

One ``name|size|mtime_seconds`` line per ``*.csv`` file, digested with the
file count; any new, changed or removed file changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csvfolder import list_files


def signature_lines(files: DataFrame) -> DataFrame:
    """One ``name|size|mtime`` line per file (mtime in whole seconds)."""
    return files.select(
        F.concat_ws(
            "|",
            F.col("file_name"),
            F.col("size").cast("string"),
            F.floor(F.unix_micros(F.col("mtime").cast("timestamp")) / 1_000_000).cast("string"),
        ).alias("line")
    )


def signature_of(lines: DataFrame, line: str = "line", exact: bool = False) -> DataFrame:
    """(signature, n_files) of a set of listing lines.

    Default: an order-free digest, the sum of the first 48 bits of each
    line's md5, as text.  It changes whenever a line is added, removed or
    altered, and it is an ordinary partial aggregate: no task holds the
    listing.  ``exact=True`` gives the reference's md5 of the sorted lines
    joined by newlines, which needs the whole listing in one task.
    """
    if exact:
        sig = F.md5(F.array_join(F.sort_array(F.collect_list(line)), "\n"))
    else:
        part = F.conv(F.substring(F.md5(F.col(line)), 1, 12), 16, 10).cast("decimal(38,0)")
        sig = F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)")).cast("string")
    return lines.agg(sig.alias("signature"), F.count(F.lit(1)).alias("n_files"))


def snapshot_signature(spark: SparkSession, folder: str, glob: str = "*.csv", exact: bool = False) -> DataFrame:
    """(signature, n_files) of a folder's listing (see ``signature_of``)."""
    return signature_of(signature_lines(list_files(spark, folder, glob)), exact=exact)
