"""Which dates of a layer have changed since something was made from them.

A table that is kept up by day stores, next to itself, the file names of each date it was made
from. Files are never changed in place, so a date whose names are the same is the same.
Nothing has to be told which dates a run touched, and a run that died before it was
done is made good by the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.layers import date_files, read_layer, write_table
from eventlake.sources.scratch import file_store

SCHEMA = "event_date date, files string"


def in_days(days: Collection[date | None]) -> Column:
    """True for rows of these dates, None being no date; reaches the directories."""
    known = [d for d in days if d is not None]
    cond = F.col("event_date").isin(known) if known else F.lit(False)
    return F.coalesce(cond, F.lit(False)) | F.col("event_date").isNull() if None in days else cond


@dataclass(frozen=True)
class Changes:
    """``days`` differ from what was noted; ``now`` is what is to be noted when done."""

    days: frozenset[date | None]
    now: dict[date | None, str]


def _names(files: Collection[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def changes(spark: SparkSession, layer: str, noted_at: str) -> Changes:
    """Compares a layer's listing with the note; one entry a date, no data is read."""
    now = {day: _names(files) for day, files in date_files(spark, layer).items()}
    where, store = file_store(spark, noted_at)
    noted = {}
    if store.exists(where):
        noted = {r.event_date: r.files for r in read_layer(spark, noted_at, schema=SCHEMA).collect()}
    days = {d for d in now.keys() | noted.keys() if now.get(d) != noted.get(d)}
    return Changes(frozenset(days), now)


def note(spark: SparkSession, found: Changes, noted_at: str) -> None:
    write_table(spark.createDataFrame(list(found.now.items()), SCHEMA), noted_at)
