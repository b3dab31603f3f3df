"""Canonical schemas, header normalisation (S2) and late-added columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS = T.StructType(
    [
        T.StructField("domain", T.StringType(), False),
        T.StructField("case_id", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("processed", T.BooleanType(), False),
        T.StructField("method", T.StringType()),
    ]
)

TAXONOMY = T.StructType(
    [
        T.StructField("domain", T.StringType(), False),
        T.StructField("categories", T.ArrayType(T.StringType()), False),
        T.StructField("keywords", T.ArrayType(T.StringType()), False),
        T.StructField("prompt_template", T.StringType()),
    ]
)

# What a scoring engine returns for one (case, domain). ``answer`` is NULL when it failed.
SCORE_FIELDS = [
    T.StructField("answer", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("margin", T.DoubleType()),
    T.StructField("probabilities", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("latency_s", T.DoubleType()),
    T.StructField("error", T.StringType()),
]

# Column names of the source export and their canonical names here.
CANONICAL_NAMES = {
    "numero_peticion": "case_id",
    "asunto": "subject",
    "fecha_ingreso": "entry_date",
    "fecha_registro": "register_date",
}

# How characters of a header change, in order of application.
_HEADER_MAP = str.maketrans(
    {
        " ": "_",
        "á": "a",
        "é": "e",
        "í": "i",
        "ó": "o",
        "ú": "u",
        "ñ": "n",
        ".": None,
        "/": "_",
        "-": "_",
        "\ufeff": None,
    }
)


def normalise_header(name: str) -> str:
    """One header cell to a column name."""
    return name.strip().lower().translate(_HEADER_MAP)


def normalise_headers(names: Iterable[str]) -> list[str]:
    """All header cells; a repeated name gets the first free suffix ``_1``, ``_2``, …"""
    taken: set[str] = set()
    result = []
    for base in map(normalise_header, names):
        name, suffix = base, 0
        while name in taken:
            suffix += 1
            name = f"{base}_{suffix}"
        taken.add(name)
        result.append(name)
    return result


def canonical_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Rename the columns the queries use; every other column is carried through."""
    names = CANONICAL_NAMES if names is None else names
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that old data lacks, NULL for its rows."""
    absent = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
