"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what one returns, written as
Parquet and read again, is the next one's ``docs``. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.llm.language import accepted, learnt_field
from casemill.llm.mixing import mixed
from casemill.llm.near_join import without_near_duplicates
from casemill.llm.packing import pack_sequences
from casemill.llm.pii import redacted
from casemill.session import staged

#: A document whose best language has a smaller share of its words is rejected.
LEAST_LANGUAGE_SHARE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or without a language most of their words are in."""
    return accepted(docs, learnt_field(docs), LEAST_LANGUAGE_SHARE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return without_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind."""
    return redacted(docs)


def mix_by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents, some of them more than once, so that sources meet their targets."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences: a row per piece."""
    return pack_sequences(docs)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("mix", mix_by_weight),
    ("pack", pack),
]

#: A field is learnt and texts are tokenized on the way: SQL can't express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
