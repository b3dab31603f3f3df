"""Stratified random sample with a quota per (domain, category)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.text import has_text

Quotas = dict[tuple[str, str], int]

# Slices of a stratum that are cut to the quota in parallel before the final cut.
SLICES = 64


def random_order(seed: int) -> Column:
    """A repeatable shuffle key: the same seed always draws the same cases."""
    return F.md5(F.concat_ws("#", F.lit(str(seed)), F.col("case_id")))


def stratified_sample(
    status: DataFrame, cases: DataFrame, quotas: Quotas, seed: int = 0
) -> DataFrame:
    """Per stratum up to its quota of random non-blank cases, fewer if there are fewer.

    Only keys are shuffled and ranked. A hot stratum is cut twice: first within ``SLICES`` parts
    of it in parallel, each to the quota, then over the survivors; a row of the final sample is
    always among the first ``quota`` of its slice, so the result is exact. How the drawn keys meet
    the texts is Spark's choice.
    """
    wanted = F.create_map(
        *[F.lit(x) for (d, c), q in quotas.items() for x in (f"{d}\x1f{c}", q)]
    ).cast("map<string,int>")
    stratum = F.concat_ws("\x1f", "domain", "category")
    largest = max(quotas.values(), default=0)
    readable = cases.filter(has_text(F.col("subject")))
    candidates = (
        status.filter(F.col("category").isNotNull())
        .select("domain", "case_id", "category", "method")
        .withColumn("quota", F.try_element_at(wanted, stratum))  # configuration, so a literal
        .filter(F.col("quota").isNotNull())
        .join(readable.select("case_id"), "case_id", "left_semi")
        .withColumn("_key", random_order(seed))
        .withColumn("_slice", F.pmod(F.hash("case_id"), F.lit(SLICES)))
    )
    order = [F.col("_key"), F.col("case_id")]
    in_slice = Window.partitionBy("domain", "category", "_slice").orderBy(*order)
    in_stratum = Window.partitionBy("domain", "category").orderBy(*order)
    drawn = (
        candidates.withColumn("_n", F.row_number().over(in_slice))
        .filter(F.col("_n") <= largest)
        .withColumn("_n", F.row_number().over(in_stratum))
        .filter(F.col("_n") <= largest)
        .filter(F.col("_n") <= F.col("quota"))
        .drop("_n", "_key", "_slice", "quota")
    )
    return readable.select("case_id", "subject").join(drawn, "case_id").select(
        "case_id",
        "domain",
        F.col("category").alias("original_category"),
        F.col("method").alias("original_method"),
        "subject",
    )
