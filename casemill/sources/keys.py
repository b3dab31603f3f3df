"""The stored case numbers in buckets, so that a load moves its own keys and no stored ones.

The key table is a part of the store like any other: a folder per load, current once a commit
names it. Its folders are bucketed and sorted on ``case_id``; for the time of a join they are
registered together as one bucketed catalogue table, so Spark reads each bucket where the join
needs it. When ``MOST_PARTS`` folders have come together, the next load writes them as one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from casemill.sources.store import Part, Store, part_token

KEYS = "case_keys"
MOST_PARTS = 16


def key_buckets(store: Store, rewritten: bool = False) -> int:
    """The buckets of the key table: the shuffle partitions of the session that wrote it whole.

    A table that is ``rewritten`` takes today's number, so buckets grow with the cluster.
    """
    schema = store.columns(KEYS)
    if schema is not None and not rewritten:
        return int(schema["case_id"].metadata["buckets"])
    return int(store.spark.conf.get("spark.sql.shuffle.partitions"))


def write_keys(store: Store, keys: DataFrame, buckets: int) -> Part:
    """The distinct ``keys`` (case_id) as a bucketed folder that no reader sees before a commit."""
    schema = T.StructType(
        [T.StructField("case_id", T.StringType(), metadata={"buckets": buckets})]
    )
    part = Part(store.new_folder(KEYS), schema)
    table = f"casemill_keys_{part_token(part.folder)}"
    rows = keys.select("case_id").repartition(buckets, "case_id")
    writer = rows.write.format("parquet").bucketBy(buckets, "case_id").sortBy("case_id")
    writer.option("path", part.folder).saveAsTable(table)
    store.spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return part


@contextmanager
def stored_keys(store: Store) -> Iterator[DataFrame]:
    """The current keys as a bucketed relation, registered while the block runs."""
    spark, folders = store.spark, store.folders(KEYS)
    if not folders:
        yield spark.createDataFrame([], "case_id string")
        return
    table = f"casemill_keys_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (case_id STRING, part STRING) USING parquet PARTITIONED BY (part) "
        f"CLUSTERED BY (case_id) SORTED BY (case_id) INTO {key_buckets(store)} BUCKETS "
        f"LOCATION {_quoted(f'{store.root}/{KEYS}')}"
    )
    try:
        places = [f"PARTITION (part='{part_token(f)}') LOCATION {_quoted(f)}" for f in folders]
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(places)}")
        yield spark.table(table).select("case_id")
    finally:
        spark.sql(f"DROP TABLE {table}")


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"
