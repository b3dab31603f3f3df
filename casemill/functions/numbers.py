"""Percentages and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as a double, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, F.lit(0.0))


def percent_text(value: Column, decimals: int) -> Column:
    """Percentage text such as ``12.3456%``."""
    return F.format_string(f"%.{decimals}f%%", value)


def thousands(n: Column) -> Column:
    """Integer text with thousands separators."""
    return F.format_number(n, 0)
