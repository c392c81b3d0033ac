"""The layer jobs: raw to Bronze to Silver to Gold, each checked after writing.

All take the caller's session and change none of its settings. A date range limits
a run to those days and replaces only their directories.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import bronze as B
from eventlake.operators import gold as G
from eventlake.operators import profile as P
from eventlake.operators import quality as Q
from eventlake.operators import silver as S
from eventlake.operators.bronze import in_dates
from eventlake.schema import BRONZE_SCHEMA, CORRUPT, PULL_REQUEST, SILVER_SCHEMA, WATCH
from eventlake.sources.ids import BUCKETS, KEY, IdIndex, not_in
from eventlake.sources.layers import read_layer, write_by_date, write_table
from eventlake.sources.manifest import in_days
from eventlake.sources.raw import read_raw
from eventlake.sources.scratch import file_store, scratch_path

GOLD_TABLES = ("top_repos_by_stars", "events_by_hour", "top_actors")


def run_bronze(
    spark: SparkSession,
    paths: Sequence[str],
    lake: str,
    start: date | None = None,
    end: date | None = None,
) -> dict[str, int]:
    """Raw files to ``bronze`` and, where needed, ``quarantine``.

    One pass parses, dates and writes, counting on the way. Only when it met lines
    that belong nowhere does a second pass set them aside: broken lines and, with a
    date range, events outside it or without a date. Without a range, events without
    a date stay in Bronze.
    """
    dated = start is not None or end is not None
    raw = B.add_event_date(read_raw(spark, paths))
    fits = F.col(CORRUPT).isNull()
    if dated:
        fits = fits & F.coalesce(B.in_dates(start, end), F.lit(False))

    seen = Observation()
    counted = raw.observe(
        seen,
        F.count(F.lit(1)).alias("lines"),
        F.count(F.col(CORRUPT)).alias("broken"),
        F.count_if(fits).alias("kept"),
    )
    kept, written = counted.filter(fits).drop(CORRUPT), Observation()
    watched = kept.observe(written, *Q.content_columns(kept))
    write_by_date(watched, f"{lake}/bronze", only=_in_range(start, end))
    counts = {k: int(v) for k, v in seen.get.items()}

    aside = raw.filter(~fits)
    if counts["lines"] == counts["kept"]:
        aside = spark.createDataFrame([], aside.schema)
    write_table(aside, f"{lake}/quarantine/{_range_name(start, end)}")

    stored = read_layer(spark, f"{lake}/bronze", start, end, BRONZE_SCHEMA)
    Q.require_same_content("events read back from bronze", Q.Content.of(written.get), Q.content(stored))
    return counts


def _range_name(start: date | None, end: date | None) -> str:
    return f"range={start or 'first'}_{end or 'last'}"


def _in_range(start: date | None, end: date | None) -> Callable[[date | None], bool] | None:
    if start is None and end is None:
        return None
    return lambda day: day is not None and (start or day) <= day <= (end or day)


def run_silver(
    spark: SparkSession,
    lake: str,
    start: date | None = None,
    end: date | None = None,
    verify: bool = True,
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Bronze to Silver. ``verify`` compares what was written with what is stored, and
    the labels with those the payloads promise.

    Silver as a whole is unique by event and label name, whatever the order of dated
    runs: an event belongs to its earliest date. So a dated run leaves out events that
    an earlier date holds, and takes those it does hold from later dates. Which date
    holds an event is looked up in the id index, which lies in buckets: the history is
    read there, one column, and not shuffled.
    """
    only = _in_range(start, end)
    source = read_layer(spark, f"{lake}/bronze", start, end, BRONZE_SCHEMA)
    path = f"{lake}/silver"
    rows = S.silver_marked(source)
    others = only and _exists(spark, path)
    if others:
        index = IdIndex(spark, lake, buckets)
        index.refresh()
        if start is not None:
            rows = not_in(rows, index.rows().filter(F.col("event_date") < F.lit(start)))
    seen = Observation()
    labelled = F.col("pr_label_name").isNotNull()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if("opens_event").alias("distinct_events"),
        F.count_if(labelled).alias("rows_with_label"),
        F.count_if(labelled & ~F.col("type").eqNullSafe(PULL_REQUEST)).alias("leaked"),
    )
    kept, written = counted.drop("opens_event"), Observation()
    if verify:
        kept = kept.observe(written, *Q.content_columns(kept))
    write_by_date(kept, path, only=only, gather=True)
    found = {k: int(v) for k, v in seen.get.items()}
    if others:
        index.refresh()
        if _take_from_later(spark, path, index.rows(), start, end):
            index.refresh()
    found["surplus_rows"] = found["rows"] - found["distinct_events"]
    leaked = found.pop("leaked")
    if verify:
        stored = read_layer(spark, path, start, end, SILVER_SCHEMA)
        Q.require_same_content("rows in silver", Q.Content.of(written.get), Q.content(stored))
        Q.require_equal("rows with leaked labels", 0, leaked)
        if only is None:
            labels = Q.label_row_expectation(S.gate_labels(source), stored).first()
            Q.require_equal("label rows", labels.distinct_label_rows, labels.actual_rows)
    return found


def _exists(spark: SparkSession, path: str) -> bool:
    where, store = file_store(spark, path)
    return store.exists(where)


def _take_from_later(
    spark: SparkSession, path: str, ids: DataFrame, start: date | None, end: date | None
) -> bool:
    """Removes events of a date range from later dates; rewrites only dates that hold any."""
    days = dates_that_hold_again(ids, start, end)
    if not days:
        return False
    silver = read_layer(spark, path, schema=SILVER_SCHEMA)
    own = ids.filter(in_dates(start, end))
    aside = scratch_path(spark, "later", f"{path}/../_scratch")
    write_table(not_in(silver.filter(in_days(days)), own), aside)
    again = spark.read.schema(SILVER_SCHEMA).parquet(aside)
    write_by_date(again, path, only=lambda day: day in days, gather=True)
    return True


def dates_that_hold_again(ids: DataFrame, start: date | None, end: date | None) -> set[date | None]:
    """Later dates, or no date, that hold an event of the date range too: one row a date."""
    return {r[0] for r in held_again(ids, start, end).collect()}


def held_again(ids: DataFrame, start: date | None, end: date | None) -> DataFrame:
    later = F.col("event_date").isNull()
    if end is not None:
        later = later | (F.col("event_date") > F.lit(end))
    own = ids.filter(in_dates(start, end)).select(KEY)
    return ids.filter(later).join(own, KEY, "left_semi").select("event_date").distinct()


def run_gold(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """Silver, all of it, to the three Gold tables; returns the written tables.

    Each table scans only the columns it groups by, and event grain costs a shuffle
    of pull request rows only, so the three scans together read less than one cached
    copy of the events would.
    """
    rows = read_layer(spark, f"{lake}/silver", schema=SILVER_SCHEMA)
    # Filtered before event grain is restored: type is the same in all rows of an
    # event, and the filter then reaches the scan.
    starred = rows.filter(F.col("type") == WATCH)
    tables = {
        "top_repos_by_stars": G.top_repos_by_stars(S.event_grain(starred, "type", "repo_name")),
        "events_by_hour": G.events_by_hour(S.event_grain(rows, "created_at")),
        "top_actors": G.top_actors(S.event_grain(rows, "actor_login")),
    }
    for name, table in tables.items():
        write_table(table, f"{lake}/gold/{name}")
    return read_gold(spark, lake)


def read_gold(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{lake}/gold/{name}") for name in GOLD_TABLES}


def findings(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The report tables; all read the small Gold tables only."""
    return {
        "top10_repos": G.first_repos(gold["top_repos_by_stars"]),
        "hours": gold["events_by_hour"].orderBy("hour"),
        "hour_peak_quiet": G.hour_peak_quiet(gold["events_by_hour"]),
        "top10_actors": G.first_actors(gold["top_actors"]),
        "non_bot_of_top": G.non_bot_of_top(gold["top_actors"]),
    }


def profile(raw: DataFrame) -> dict[str, DataFrame]:
    """Profiling reports of raw or Bronze rows, as unevaluated tables."""
    core = P.core_projection(raw)
    return {
        "sample": P.nested_select(raw).limit(20),
        "total_events": P.total_events(core),
        "events_by_type": P.events_by_type(core),
        "type_share": P.type_share(core),
        "duplicate_ids": P.duplicate_ids(core),
        "created_at_range": P.created_at_range(core),
        "public_counts": P.public_counts(core),
        "org_null_ratio": P.org_null_ratio(core),
        "cardinalities": P.cardinalities(core),
        "top_actors": G.top_actors(core, 10),
        "top_repos_by_events": G.top_repos_by_events(core, 10),
        "payload_union_schema": P.payload_union_schema(raw),
        "missing_payload_fields": Q.missing_payload_fields(raw),
        "payload_field_presence": P.payload_field_presence(raw),
        "array_field_profile": P.array_field_profile(raw),
    }


def run_all(
    spark: SparkSession,
    paths: Sequence[str],
    lake: str,
    start: date | None = None,
    end: date | None = None,
) -> dict[str, DataFrame]:
    """Raw files to findings in one session; stops at the first failed check."""
    run_bronze(spark, paths, lake, start, end)
    run_silver(spark, lake, start, end)
    return findings(run_gold(spark, lake))
