"""Gold kept up by day: counts of each date, merged by month, ranked from the months.

Counts add up, so Gold needs only the dates of Silver that have changed since the last
run: their counts are made anew and replace the old ones, then the months they lie in are
added up again from their dates, and the tables are ranked from the months. A run over one
more day reads that day of Silver, one month of daily counts and all monthly counts,
whatever the length of the history. Which dates have changed is seen from their files
(``sources.manifest``), so it does not matter what changed them: a run of that date, an
event that moved to an earlier date, a full run.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.timestamps import hour_of_day
from eventlake.operators import silver as S
from eventlake.operators.keep import count_by, top
from eventlake.plans.jobs import read_gold
from eventlake.schema import SILVER_SCHEMA, TOP_N, WATCH
from eventlake.sources.layers import read_layer, write_by_date, write_table
from eventlake.sources.manifest import changes, in_days, note
from eventlake.sources.scratch import file_store


@dataclass(frozen=True)
class GoldTable:
    """A Gold table as counts: of the events of ``type``, by ``key`` made from ``column``."""

    key: str
    key_type: str
    measure: str
    column: str
    made: Column | None = None
    type: str | None = None

    @property
    def schema(self) -> str:
        return f"{self.key} {self.key_type}, {self.measure} bigint, event_date date"

    def counts(self, silver: DataFrame) -> DataFrame:
        """(key, count, event_date) of the events of some dates; each lies on one date."""
        if self.type:
            silver = silver.filter(F.col("type") == self.type)
        events = S.event_grain(silver, "type", "event_date", self.column)
        made = F.col(self.column) if self.made is None else self.made
        return count_by(events, made.alias(self.key), "event_date", name=self.measure)

    def merged(self, counts: DataFrame, *by: Column) -> DataFrame:
        return counts.groupBy(self.key, *by).agg(F.sum(self.measure).alias(self.measure))

    def ranked(self, counts: DataFrame) -> DataFrame:
        whole = self.merged(counts)
        if self.key == "hour":
            return whole.orderBy("hour")
        return top(whole, TOP_N, self.measure, self.key)


def gold_tables() -> dict[str, GoldTable]:
    return {
        "top_repos_by_stars": GoldTable("repo_name", "string", "star_count", "repo_name", type=WATCH),
        "events_by_hour": GoldTable("hour", "int", "event_count", "created_at", hour_of_day("created_at")),
        "top_actors": GoldTable("actor_login", "string", "event_count", "actor_login"),
    }


def silver_of(spark: SparkSession, lake: str, days: Collection[date | None]) -> DataFrame:
    """Silver rows of these dates; only their directories are read."""
    return read_layer(spark, f"{lake}/silver", schema=SILVER_SCHEMA).filter(in_days(days))


def month_of(day: date | None) -> date | None:
    return day and day.replace(day=1)


def in_months(months: Collection[date | None]) -> Column:
    """True for rows of these months; reaches the directories of the dates."""
    first = F.trunc("event_date", "MM")
    known = [m for m in months if m is not None]
    cond = first.isin(known) if known else F.lit(False)
    return F.coalesce(cond, F.lit(False)) | F.col("event_date").isNull() if None in months else cond


def refresh(spark: SparkSession, lake: str, name: str, table: GoldTable, days: Collection[date | None]) -> None:
    """Replaces the counts of these dates and of their months."""
    state, months = f"{lake}/gold_counts", {month_of(d) for d in days}
    write_by_date(
        table.counts(silver_of(spark, lake, days)), f"{state}/day/{name}",
        only=lambda day: day in days, gather=True, sort_by=(table.key,),
    )
    daily = read_layer(spark, f"{state}/day/{name}", schema=table.schema).filter(in_months(months))
    monthly = table.merged(daily, F.trunc("event_date", "MM").alias("event_date"))
    write_by_date(
        monthly, f"{state}/month/{name}", only=lambda month: month in months, gather=True, sort_by=(table.key,),
    )


def run_gold_by_day(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The Gold tables of all of Silver, from the dates that have changed; returns them.

    The same tables as ``jobs.run_gold``. What was read is noted last: after a run that
    died, the next one does the same dates again, which changes nothing twice.
    """
    noted_at = f"{lake}/gold_counts/made_from"
    found = changes(spark, f"{lake}/silver", noted_at)
    for name, table in gold_tables().items():
        path = f"{lake}/gold_counts/month/{name}"
        where, store = file_store(spark, path)
        if found.days or not store.exists(where):
            refresh(spark, lake, name, table, found.days)
        months = read_layer(spark, path, schema=table.schema)
        write_table(table.ranked(months), f"{lake}/gold/{name}")
    if found.days:
        note(spark, found, noted_at)
    return read_gold(spark, lake)
