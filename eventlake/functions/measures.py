"""Small numeric helpers for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole as a rounded double; NULL for an empty whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(
        F.try_divide(part.cast("double") * 100, whole.cast("double")), digits
    )


def spread_percent(high: Column, low: Column, digits: int = 1) -> Column:
    """How far high lies above low, in percent."""
    return F.round((F.try_divide(high.cast("double"), low.cast("double")) - 1) * 100, digits)
