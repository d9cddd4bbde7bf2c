"""Ratios that are null, not an error, where the denominator is zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def percent(num: Column, den: Column) -> Column:
    return F.try_divide(F.lit(100.0) * num, den)


def thousands(value: Column, digits: int = 2) -> Column:
    """``1,234.50``: a number for display."""
    return F.format_number(value, digits)


def nonzero(value: Column) -> Column:
    """Zero counts as absent."""
    return F.nullif(value, F.lit(0))


def filled(value: Column) -> Column:
    """Empty text counts as absent."""
    return F.nullif(value, F.lit(""))
