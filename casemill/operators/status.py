"""Status rows: one per case and domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seed_status(
    keys: DataFrame, domains: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """A pending row per key and domain. A projection: no join and no shuffle.

    ``keep`` names further columns of the keys to carry along.
    """
    named = F.explode(F.array(*map(F.lit, domains))).alias("domain")
    return _pending(keys.select("case_id", named, *keep), keep)


def missing_status(
    keys: DataFrame, status: DataFrame, domains: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Pending rows for every (key, domain) that ``status`` lacks.

    Joined on the key alone, so the keys cross the network once instead of once per domain, and
    not at all when both sides are bucketed on ``case_id``.
    """
    has = {name: f"has_{position}" for position, name in enumerate(domains)}
    present = status.groupBy("case_id").agg(
        *[F.bool_or(F.col("domain") == name).alias(flag) for name, flag in has.items()]
    )
    lacking = F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(F.col(flag), F.lit(False)), None).otherwise(name)
                for name, flag in has.items()
            ]
        )
    )
    return _pending(
        keys.select("case_id", *keep)
        .join(present, "case_id", "left")
        .select("case_id", F.explode(lacking).alias("domain"), *keep),
        keep,
    )


def orphan_count(status: DataFrame, cases: DataFrame) -> DataFrame:
    """Status rows per domain whose case is not in the master table."""
    return (
        status.join(cases.select("case_id"), "case_id", "left_anti")
        .groupBy("domain")
        .agg(F.count("*").alias("orphans"))
    )


def _pending(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    return rows.select(
        "domain",
        "case_id",
        F.lit(None).cast("string").alias("category"),
        F.lit(False).alias("processed"),
        F.lit(None).cast("string").alias("method"),
        *keep,
    )


def rewrite(joined: DataFrame, status: DataFrame, **changed: Column) -> DataFrame:
    """The status rows with some columns replaced; all others are carried through in order."""
    return joined.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in status.columns]
    )
