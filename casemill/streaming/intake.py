"""Newly landed export files as micro-batches into the store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from casemill.operators.taxonomy import Domain
from casemill.plans.cycle import load_rows
from casemill.sources.delimited import read_export
from casemill.sources.store import Store

# What Spark's file source tells about each file; of these only the path is read.
FILES = "path string, modificationTime timestamp, length long, content binary"


def start_intake(
    store: Store,
    landing: str,
    domains: Sequence[Domain],
    checkpoint: str,
    names: Sequence[str] | None = None,
    multiline: bool = True,
    files_per_batch: int = 64,
) -> StreamingQuery:
    """Load every file that landed since the last run, then stop (``availableNow``).

    The stream carries paths only, never contents; each batch of files is then read like any
    export, every file by its own header. The stream remembers paths: a file that grows in place
    is not read again, so land new versions under new names or use the ledger. A batch that is
    replayed after a failure inserts nothing twice, because its keys are already stored.
    """
    spark = store.spark

    def load(batch: DataFrame, _: int) -> None:
        paths = [r.path for r in batch.collect()]  # at most files_per_batch
        if paths:
            load_rows(store, read_export(spark, paths, multiline, names), domains)

    landed = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
    )
    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
