"""Summaries over event grain, and the findings read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.accounts import is_not_bot
from eventlake.functions.measures import spread_percent
from eventlake.functions.timestamps import hour_of_day
from eventlake.operators.keep import count_by, top
from eventlake.schema import FINDINGS_N, TOP_N, WATCH


def stars_per_repo(events: DataFrame) -> DataFrame:
    starred = events.filter(F.col("type") == WATCH)
    return count_by(starred, "repo_name", name="star_count")


def top_repos_by_stars(events: DataFrame, n: int = TOP_N) -> DataFrame:
    return top(stars_per_repo(events), n, "star_count", "repo_name")


def events_by_hour(events: DataFrame) -> DataFrame:
    """Events per UTC hour of day over all days, ordered by hour.

    Hours without events are absent; events without a timestamp form a NULL hour.
    """
    hours = count_by(events, hour_of_day("created_at").alias("hour"))
    return hours.orderBy("hour")


def events_by_date_and_hour(events: DataFrame) -> DataFrame:
    """The same per day."""
    return count_by(events, "event_date", hour_of_day("created_at").alias("hour"))


def top_actors(events: DataFrame, n: int = TOP_N) -> DataFrame:
    return top(count_by(events, "actor_login"), n, "event_count", "actor_login")


def top_non_bot_actors(events: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n busiest actors without the bot suffix (filter, then rank)."""
    return top_actors(events.filter(is_not_bot("actor_login")), n)


def top_repos_by_events(events: DataFrame, n: int = FINDINGS_N) -> DataFrame:
    return top(count_by(events, "repo_name"), n, "event_count", "repo_name")


# Findings: the inputs below are the small Gold tables.


def first_repos(top_repos: DataFrame, n: int = FINDINGS_N) -> DataFrame:
    return top(top_repos, n, "star_count", "repo_name")


def first_actors(ranked: DataFrame, n: int = FINDINGS_N) -> DataFrame:
    return top(ranked, n, "event_count", "actor_login")


def non_bot_of_top(ranked: DataFrame) -> DataFrame:
    """Non-bots among the stored top actors (rank, then filter), so possibly few."""
    return ranked.filter(is_not_bot("actor_login")).orderBy(
        F.desc("event_count"), "actor_login"
    )


def hour_peak_quiet(by_hour: DataFrame) -> DataFrame:
    """Busiest and quietest hour and the spread between them; ties: earliest hour."""
    count, hour = F.col("event_count"), F.col("hour")
    return by_hour.agg(
        F.max_by("hour", F.struct(count, -hour)).alias("peak_hour"),
        F.max(count).alias("peak_count"),
        F.min_by("hour", F.struct(count, hour)).alias("quiet_hour"),
        F.min(count).alias("quiet_count"),
        F.sum(count).alias("total_events"),
        spread_percent(F.max(count), F.min(count)).alias("spread_pct"),
    )
