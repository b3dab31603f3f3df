"""Reset (P2), purge (P3) and period selection (F4, F5, S14) by date prefix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions.dates import in_periods, raw_in_periods
from casemill.operators.status import rewrite


def _dates() -> tuple[Column, Column]:
    return F.col("entry_date"), F.col("register_date")


def cases_in_periods(cases: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Cases that entered or were registered in any of the periods; pushed to the scan."""
    return cases.filter(raw_in_periods(prefixes, *_dates()))


def export_period(cases: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """The cases of the periods with all their columns, by entry date."""
    return cases_in_periods(cases, prefixes).orderBy(F.col("entry_date").asc_nulls_last())


def reset_status(
    status: DataFrame,
    cases: DataFrame,
    prefixes: Sequence[str],
    domains: Sequence[str] | None = None,
    keep_method: bool = False,
) -> DataFrame:
    """Status rows of the periods' cases are pending again.

    All domains unless some are named. ``keep_method=True`` leaves the old method in place.
    """
    chosen = cases_in_periods(cases, prefixes).select("case_id", F.lit(True).alias("_hit"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if domains is not None:
        hit = hit & F.col("domain").isin(list(domains))
    method = F.col("method") if keep_method else F.when(~hit, F.col("method"))
    return rewrite(
        status.join(chosen, "case_id", "left"),
        status,
        category=F.when(~hit, F.col("category")),
        processed=F.col("processed") & ~hit,
        method=method,
    )


def purge_cases(cases: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """The cases that stay. A filter, no join."""
    return cases.filter(~in_periods(prefixes, *_dates()))


def purge_status(
    status: DataFrame,
    cases: DataFrame,
    prefixes: Sequence[str],
    domains: Sequence[str] | None = None,
) -> DataFrame:
    """The status rows that stay; ``cases`` is the master table before the purge."""
    victims = cases_in_periods(cases, prefixes).select("case_id")
    if domains is None:
        return rewrite(status.join(victims, "case_id", "left_anti"), status)
    owners = status.filter(F.col("domain").isin(list(domains)))
    others = status.filter(~F.col("domain").isin(list(domains)))
    return rewrite(owners.join(victims, "case_id", "left_anti"), status).unionByName(others)
