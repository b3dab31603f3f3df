"""Delimited exports in (S1..S3) and out (S14..S16)."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.schema import canonical_columns, normalise_headers

# Fixed value: the separator of the source export.
SEPARATOR = "»"

RAGGED = "was_ragged"
LOAD_ORDER = "load_order"
_CORRUPT = "_corrupt_record"


def _options(multiline: bool, header: bool) -> dict[str, str]:
    return {
        "sep": SEPARATOR,
        "header": str(header).lower(),
        "quote": '"',
        "escape": '"',
        "encoding": "UTF-8",
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        # A pruned reader would not notice that a row has too few or too many fields.
        "columnPruning": "false",
        "maxCharsPerColumn": "-1",
    }


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The normalised column names of one export; reads its first record only."""
    first = spark.read.options(**_options(True, False)).csv(path).head()
    if first is None:
        raise ValueError(f"no header in {path}")
    return normalise_headers([cell or "" for cell in first])


def read_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """S2 for many files: file and normalised column names, found by one job.

    The tasks that read the starts of files each keep the first line of a file, so one row a file
    is shuffled and returned, as many as the listing has. A header cell may hold quotes and
    separators; only a header whose quotes don't close in its first line is read again by itself.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("place"),
    )
    firsts = (
        lines.filter("block_start = 0 AND trim(value) <> ''")
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("line"))
        .collect()
    )
    cells = {line: _header_cells(line) for line in {r.line for r in firsts}}
    names = {line: normalise_headers(c) for line, c in cells.items() if c is not None}
    files = {unquote(r.file): r.line for r in firsts}  # the metadata column has an encoded URI
    return {f: names[n] if n in names else read_header(spark, f) for f, n in files.items()}


def _header_cells(line: str) -> list[str] | None:
    """The cells of a header line, None if its last quoted cell goes on in the next line."""
    if line.count('"') % 2:
        return None
    return next(csv.reader([line.removeprefix("\ufeff")], delimiter=SEPARATOR), [])


def export_schema(names: Sequence[str]) -> T.StructType:
    """Every column is text; the corrupt-record column marks ragged rows."""
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])


def read_export(
    spark: SparkSession,
    path: str | Sequence[str],
    multiline: bool = True,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """S1 + S3: an export as canonical text columns plus ``was_ragged`` and ``load_order``.

    Every file is read by its own header (one job finds them all), files with equal headers
    together; columns that a file lacks are NULL; an empty file has no rows. ``names`` overrides all headers.
    Short rows are padded with NULL, long rows are cut, both are flagged. An empty field is NULL.
    ``multiline=False`` lets Spark split a file among tasks; use it when no quoted field holds a
    line break. ``load_order`` sorts rows by file time, file, position: "first in the file".
    """
    if names is not None:
        return _read_alike(spark, path, multiline, list(names))
    alike: dict[tuple[str, ...], list[str]] = {}
    headers = read_headers(spark, path)
    for file in sorted(headers):
        alike.setdefault(tuple(headers[file]), []).append(file)
    if not alike:
        raise ValueError(f"no export in {path}")
    parts = [_read_alike(spark, files, multiline, list(n)) for n, files in alike.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_alike(
    spark: SparkSession, path: str | Sequence[str], multiline: bool, names: list[str]
) -> DataFrame:
    reader = spark.read.options(**_options(multiline, True)).schema(export_schema(names))
    return tidy_export(reader.csv(path), names)


def tidy_export(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """Canonical columns, flags and order of a raw export DataFrame."""
    order = F.struct(
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("position"),
    )
    rows = raw.select(
        *[_clean(F.col(f"`{n}`")).alias(n) for n in names],
        F.col(_CORRUPT).isNotNull().alias(RAGGED),
        order.alias(LOAD_ORDER),
    )
    renamed = canonical_columns(rows)
    if "case_id" not in renamed.columns:
        renamed = renamed.withColumnRenamed(names[0], "case_id")  # the first column is the key
    return renamed


def _clean(text: Column) -> Column:
    """Line breaks as ``\\n``; empty is NULL."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.nullif(unix, F.lit(""))


def write_delimited(
    df: DataFrame, path: str, separator: str = SEPARATOR, single_file: bool = False
) -> None:
    """CSV with header; quotes are doubled and NULL is empty.

    ``single_file`` is for reports, whose size is the number of months or categories.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("error").options(
        sep=separator,
        header="true",
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace="false",  # a writer would strip texts
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def write_rows(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """JSON lines under ``{path}/json`` and, for the chosen columns, CSV under ``{path}/csv``."""
    df.write.mode("error").json(f"{path}/json", ignoreNullFields=False)
    flat = df.select(*columns) if columns else df
    write_delimited(flat, f"{path}/csv", separator=",")
