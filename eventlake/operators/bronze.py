"""Raw lines to Bronze: content untouched, one technical column added."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.timestamps import parse_utc_date
from eventlake.schema import CORRUPT


def add_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", parse_utc_date("created_at"))


def is_broken(raw: DataFrame) -> Column:
    """True for a line that does not parse under the schema."""
    return raw[CORRUPT].isNotNull()


def bronze(raw: DataFrame) -> DataFrame:
    """Readable events with their date; broken lines are left to ``broken_lines``."""
    if CORRUPT in raw.columns:
        raw = raw.filter(~is_broken(raw)).drop(CORRUPT)
    return add_event_date(raw)


def broken_lines(raw: DataFrame) -> DataFrame:
    """Lines that do not parse under the schema, with whatever could be read."""
    return raw.filter(is_broken(raw))


def corrupt_count(raw: DataFrame) -> DataFrame:
    """Lines read, broken lines and readable events, in one pass."""
    broken = F.count_if(is_broken(raw))
    lines = F.count(F.lit(1))
    return raw.agg(
        lines.alias("lines"),
        broken.alias("broken_lines"),
        (lines - broken).alias("events"),
    )


def in_dates(start: date | None, end: date | None, column: str = "event_date") -> Column:
    """Inclusive date range on the partition column; open where a bound is None."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(column) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(column) <= F.lit(end))
    return cond
