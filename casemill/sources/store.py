"""Tables whose state changes, kept as immutable Parquet folders (Parquet has no UPDATE).

A table is a list of folders. A change writes new folders and then appends one row per table to a
commit log; readers follow the newest row. Several tables change together in one append. A job
that dies before the append leaves the tables as they were. One writer at a time.

``append`` adds a folder, so a load writes only its new cases; ``replace`` starts a new list, so
rewriting the small set of pending rows does not touch the finished ones. The log also keeps the
columns, so opening a table reads no file footers and late columns are NULL for older rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.session import file_names, path_exists, remove_staged

_LOG = "name string, version long, folders array<string>, columns string"
_TAGS = "stamp string, name string, folders array<string>, columns string"


# Column that names the folder of a row.
PART = "_part"
_PART_PATTERN = "/part=([0-9a-f]{32})/"


def part_token(folder: str) -> str:
    """The part of a folder's name that is its own, however its path is written."""
    return folder.rpartition("part=")[2]


@dataclass(frozen=True)
class Part:
    """A written folder that a commit can make current."""

    folder: str
    schema: T.StructType


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    _read: dict = field(default_factory=dict, repr=False, compare=False)

    def _current(self) -> dict[str, tuple[int, list[str], T.StructType]]:
        """Newest version, folders and columns per table: one row per table of the store.

        The log is read again when it has other files than last time.
        """
        files = file_names(self.spark, f"{self.root}/_commits")
        if files not in self._read:
            self._read.clear()
            self._read[files] = self._newest() if files else {}
        return self._read[files]

    def _newest(self) -> dict[str, tuple[int, list[str], T.StructType]]:
        log = self.spark.read.schema(_LOG).parquet(f"{self.root}/_commits")
        newest = log.groupBy("name").agg(
            F.max_by(F.struct("version", "folders", "columns"), "version").alias("c")
        )
        return {
            r["name"]: (r.c.version, list(r.c.folders), _schema(r.c["columns"]))
            for r in newest.collect()
        }

    def read(self, name: str, empty: T.StructType | str) -> DataFrame:
        """The table's current rows; a table that does not exist yet is empty."""
        _, folders, schema = self._current().get(name, (0, [], None))
        if not folders:
            return self.spark.createDataFrame([], empty)
        return self._open(name, folders, schema)

    def _open(self, name: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*folders).select(*[f"`{n}`" for n in schema.fieldNames()])

    def folders(self, name: str) -> list[str]:
        return self._current().get(name, (0, [], None))[1]

    def columns(self, name: str) -> T.StructType | None:
        """The columns of a table that has been committed once."""
        return self._current().get(name, (0, [], None))[2]

    def new_folder(self, name: str) -> str:
        return f"{self.root}/{name}/part={uuid.uuid4().hex}"

    def read_parts(self, name: str, empty: T.StructType | str) -> DataFrame:
        """The current rows with the folder each one is in, as ``PART``."""
        _, folders, schema = self._current().get(name, (0, [], None))
        if not folders:
            return self.spark.createDataFrame([], empty).withColumn(PART, F.lit(""))
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        token = F.regexp_extract("_metadata.file_path", _PART_PATTERN, 1).alias(PART)
        return reader.parquet(*folders).select(*[f"`{n}`" for n in schema.fieldNames()], token)

    def read_folders(self, name: str, tokens: Sequence[str]) -> DataFrame:
        """The rows of some of the current folders, given by their tokens."""
        _, folders, schema = self._current()[name]
        return self._open(name, [f for f in folders if part_token(f) in set(tokens)], schema)

    def tag(self, stamp: str) -> None:
        """S17 without a copy: keep the current state under a name; folders never change."""
        rows = [(stamp, n, f, c.json()) for n, (_, f, c) in self._current().items()]
        tags = self.spark.createDataFrame(rows, _TAGS)
        tags.coalesce(1).write.mode("append").parquet(f"{self.root}/_tags")

    def latest_tag(self) -> str | None:
        """The newest tag, None before the first."""
        if not path_exists(self.spark, f"{self.root}/_tags"):
            return None
        tags = self.spark.read.schema(_TAGS).parquet(f"{self.root}/_tags")
        return tags.agg(F.max("stamp")).head()[0]

    def read_tag(
        self, stamp: str, name: str, empty: T.StructType | str | None = None
    ) -> DataFrame:
        """A table as it was when it was tagged; ``empty`` stands for one that didn't exist yet."""
        tags = self.spark.read.schema(_TAGS).parquet(f"{self.root}/_tags").filter(
            F.col("stamp") == stamp
        )
        row = tags.filter(F.col("name") == name).head()
        if row is None:
            if empty is not None and not tags.isEmpty():
                return self.spark.createDataFrame([], empty)
            raise ValueError(f"no table {name!r} under tag {stamp!r}")
        return self._open(name, row["folders"], _schema(row["columns"]))

    def write_part(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
    ) -> Part:
        """Write rows that no reader sees until a commit names their folder.

        ``sort_by`` sorts within the files, so that row groups can be skipped.
        """
        part = Part(self.new_folder(name), df.schema)
        rows = df.sortWithinPartitions(*sort_by) if sort_by else df
        rows.write.mode("error").partitionBy(*partition_by).parquet(part.folder)
        return part

    def open_part(self, part: Part) -> DataFrame:
        """The rows of one written folder."""
        return self.spark.read.schema(part.schema).parquet(part.folder)

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """Compute rows once into the store and read them from there; never committed."""
        return self.open_part(self.write_part(name, df))

    @contextmanager
    def scratch(self) -> Iterator[Callable[[str, DataFrame], DataFrame]]:
        """``staged`` for a job that keeps nothing of it: the folders go when the block ends."""
        parts: list[Part] = []

        def stage(name: str, df: DataFrame) -> DataFrame:
            parts.append(self.write_part(name, df))
            return self.open_part(parts[-1])

        try:
            yield stage
        finally:
            for part in parts:
                remove_staged(self.spark, part.folder)

    @contextmanager
    def bucketed(
        self, name: str, df: DataFrame, column: str, buckets: int
    ) -> Iterator[tuple[DataFrame, DataFrame]]:
        """``staged`` in buckets of a column, for a job that keeps nothing of it.

        Every task writes the buckets of its own rows, so no row moves. The rows are given twice: as
        a folder, whose files are split among tasks, and as a bucketed relation, whose rows stay
        where they are in a join that deals the other side by this column into as many buckets.
        """
        part = Part(self.new_folder(name), df.schema)
        table = f"casemill_{name}_{part_token(part.folder)}"
        writer = df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, column)
        try:
            writer.option("path", part.folder).saveAsTable(table)
            yield self.open_part(part), self.spark.table(table)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove_staged(self.spark, part.folder)

    def commit(
        self,
        append: Mapping[str, Part] | None = None,
        replace: Mapping[str, Part] | None = None,
        drop: Mapping[str, Sequence[str]] | None = None,
    ) -> None:
        """Make written folders current, all tables at once; ``drop`` names folders that go."""
        current = self._current()
        rows = []
        append, drop = append or {}, drop or {}
        for name in dict.fromkeys([*append, *drop]):
            version, folders, schema = current.get(name, (0, [], None))
            gone = set(drop.get(name, ()))
            folders = [f for f in folders if part_token(f) not in gone]
            columns = None if schema is None else schema.json()
            if name in append:
                folders = [*folders, append[name].folder]
                columns = _merged(schema, append[name].schema)
            if columns is not None:
                rows.append((name, version + 1, folders, columns))
        for name, part in (replace or {}).items():
            version, _, _ = current.get(name, (0, [], None))
            rows.append((name, version + 1, [part.folder], part.schema.json()))
        log = self.spark.createDataFrame(rows, _LOG)
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")

    def append(self, name: str, df: DataFrame) -> None:
        self.commit(append={name: self.write_part(name, df)})

    def replace(self, name: str, df: DataFrame) -> None:
        self.commit(replace={name: self.write_part(name, df)})


def _schema(columns: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(columns))


def _merged(old: T.StructType | None, new: T.StructType) -> str:
    known = [] if old is None else list(old.fields)
    names = {f.name for f in known}
    return T.StructType([*known, *[f for f in new.fields if f.name not in names]]).json()


def write_snapshot(tables: Mapping[str, DataFrame], root: str, stamp: str, inserted: int) -> bool:
    """All tables under ``{root}/snapshot={stamp}``, only when rows were inserted.

    A manifest row is added last, so an interrupted snapshot is never the latest. ``root`` may be
    an object-store path.
    """
    if not inserted:
        return False
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{root}/snapshot={stamp}/{name}")
    if spark is not None:
        manifest = spark.createDataFrame(
            [(stamp, list(tables))], "snapshot string, tables array<string>"
        )
        manifest.coalesce(1).write.mode("append").parquet(f"{root}/_manifest")
    return True


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """The newest complete snapshot."""
    if not path_exists(spark, f"{root}/_manifest"):
        return None
    return spark.read.parquet(f"{root}/_manifest").agg(F.max("snapshot")).head()[0]


ADDED, CHANGED, REMOVED = "added", "changed", "removed"


def table_difference(
    before: DataFrame, after: DataFrame, key: str | Sequence[str]
) -> DataFrame:
    """``key`` columns and ``change`` of every row that differs between two states of a table.

    Rows are compared by a hash of their other columns, so keys and two numbers a row are what is
    shuffled. A column that only one state has counts as NULL in the other. Keys don't repeat.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = sorted({*before.columns, *after.columns} - set(keys))

    def digested(df: DataFrame, name: str) -> DataFrame:
        own = set(df.columns)
        values = [F.col(f"`{n}`") if n in own else F.lit(None).cast("string") for n in names]
        texts = [F.to_json(F.struct(v.alias("v"))) for v in values]  # a NULL is an empty object
        whole = F.unhex(F.sha2(F.concat_ws("\x1f", *texts), 256))
        return df.select(*[F.col(f"`{k}`") for k in keys], whole.alias(name))

    joined = digested(before, "_old").join(digested(after, "_new"), keys, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), ADDED)
        .when(F.col("_new").isNull(), REMOVED)
        .when(F.col("_old") != F.col("_new"), CHANGED)
    )
    return joined.select(*keys, change.alias("change")).filter("change IS NOT NULL")


def write_bucketed(df: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """A catalogue table bucketed and sorted on ``case_id``.

    Joins between ``cases`` and ``status`` bucketed alike need no shuffle and no sort.
    """
    writer = df.write.bucketBy(buckets, "case_id").sortBy("case_id").mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(table)
