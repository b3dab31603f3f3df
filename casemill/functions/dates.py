"""Dates are text; periods are prefixes of it (``YYYY`` or ``YYYY-MM``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label of a missing month in the published reports.
NO_DATE = "Sin fecha"


def month_of(date: Column) -> Column:
    """The ``YYYY-MM`` part."""
    return F.substring(date, 1, 7)


def month_label(date: Column) -> Column:
    """The month, or the missing-month label."""
    return F.coalesce(F.nullif(month_of(date), F.lit("")), F.lit(NO_DATE))


def months_of_year(year: int, first: int, last: int) -> list[str]:
    """the month prefixes from ``first`` to ``last``, both included."""
    return [f"{year}-{month:02d}" for month in range(first, last + 1)]


def in_periods(prefixes: Sequence[str], *dates: Column) -> Column:
    """any of the dates starts with any of the prefixes. Never NULL.

    A plain OR of ``startswith`` reaches the Parquet reader as StringStartsWith filters.
    """
    if not prefixes:
        raise ValueError("at least one period prefix is needed")
    return F.coalesce(raw_in_periods(prefixes, *dates), F.lit(False))


def raw_in_periods(prefixes: Sequence[str], *dates: Column) -> Column:
    """As :func:`in_periods` but NULL-able: the form to use inside ``filter`` (it is pushed)."""
    return reduce(or_, [date.startswith(p) for date in dates for p in prefixes])
