"""Raw engine answers to categories (C7, C8). NULL means the engine failed.

Each step is a projection of its own, because the next one reads it several times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.fixed_values import ANSWER_LABEL, NOT_APPLICABLE
from casemill.functions.text import first_contained, strip_all
from casemill.operators.taxonomy import Domain, by_domain

_STEPS = ("_text", "_loud", "_lowered")


def _category(lowered: str, domains: Sequence[Domain]) -> Column:
    """The first category of the row's domain that occurs in the answer."""
    found = {d.name: first_contained(F.col(lowered), d.categories) for d in domains}
    return F.coalesce(by_domain(F.col("domain"), found), F.lit(NOT_APPLICABLE))


def normalise_generated(rows: DataFrame, domains: Sequence[Domain]) -> DataFrame:
    """The free text in ``answer`` becomes a category or ``NO_APLICA``."""
    unlabelled = F.replace(F.col("_text"), F.lit(ANSWER_LABEL), F.lit(""))
    refused = F.col("_loud").contains(NOT_APPLICABLE) | F.col("_loud").contains(
        NOT_APPLICABLE.replace("_", " ")
    )
    answer = F.when(refused, NOT_APPLICABLE).otherwise(_category("_lowered", domains))
    return (
        rows.withColumn("_text", strip_all(F.col("answer")))
        .withColumn("_loud", F.when(F.col("_text") != "", strip_all(unlabelled)))
        .withColumns({"_loud": F.upper("_loud"), "_lowered": F.lower("_loud")})
        .withColumn("answer", F.when(F.col("_loud").isNotNull(), answer))
        .drop(*_STEPS)
    )


def normalise_choice(rows: DataFrame, domains: Sequence[Domain]) -> DataFrame:
    """The choice in ``answer`` becomes a category or ``NO_APLICA``."""
    given = F.col("answer")
    answer = F.when(given == NOT_APPLICABLE, NOT_APPLICABLE).otherwise(
        _category("_lowered", domains)
    )
    return (
        rows.withColumn("_lowered", F.lower("answer"))
        .withColumn("answer", F.when(given != "", answer))
        .drop("_lowered")
    )
