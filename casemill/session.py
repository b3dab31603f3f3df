"""Session settings and durable lineage cuts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Temporary folder of each local session that names none.
_LOCAL_FOLDERS: dict[str, str] = {}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts can be long: small Arrow batches keep a Python engine's memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Recording a Python call site for every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "casemill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rows_stay_dealt(spark: SparkSession) -> Iterator[None]:
    """While the block runs, a join takes rows that lie in buckets of some of its keys as they lie.

    Otherwise Spark deals them again by all keys of the join.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that driver and executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of its own; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        made = tempfile.mkdtemp(prefix="casemill-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _LOCAL_FOLDERS[context.applicationId] = made
    return _LOCAL_FOLDERS[context.applicationId]


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and read it from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    """A new place for intermediate data in the shared folder."""
    return f"{shared_folder(spark)}/casemill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet to ``path`` and read it from there.

    Unlike ``durable`` the copy is compressed and columnar, and later readers prune its columns.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to a new place of the shared folder and read it from there."""
    return written(df, staging_path(df.sparkSession, name))


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def file_names(spark: SparkSession, path: str) -> frozenset[str]:
    """The names in a folder, none if it doesn't exist."""
    if not path_exists(spark, path):
        return frozenset()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return frozenset(entry.getPath().getName() for entry in listed)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """What the files under a folder take, as their file system lists them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength()


def remove_staged(spark: SparkSession, path: str) -> None:
    """Remove what ``written`` has put at ``path``; nothing may read it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
