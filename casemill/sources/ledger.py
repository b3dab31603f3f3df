"""Which source files are new or changed since they were last processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "path string, length long, modified timestamp"


def list_sources(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and time of every file; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=pattern, recursiveFileLookup="true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def list_rows(rows: DataFrame) -> DataFrame:
    """Path, number of rows and time of every file that ``rows`` are read from.

    Where a file's size says little, as after a filter, its rows are what is compared. Counted by
    the tasks that read the file; one row a file and task is shuffled.
    """
    return (
        rows.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .groupBy("path", "modified")
        .agg(F.count("*").alias("length"))
        .select("path", "length", "modified")
    )


def changed_sources(listing: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Files whose path, length and time are not in the ledger; ``force`` takes all.

    A file that grew, shrank or was rewritten at the same size counts as changed.
    """
    if force:
        return listing
    return listing.join(ledger, ["path", "length", "modified"], "left_anti")
