"""Every query by name: (spark, sf_dir) to DataFrame, over the whole events table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.payload import labels, pr_labels
from eventlake.functions.timestamps import hour_of_day
from eventlake.operators import bronze as B
from eventlake.operators import gold as G
from eventlake.operators import profile as P
from eventlake.operators import quality as Q
from eventlake.operators import silver as S
from eventlake.plans import daily, jobs
from eventlake.schema import BRONZE_SCHEMA, EVENT_COLUMNS, EVENT_SCHEMA, LABEL_SCHEMA, PUSH, REST, SILVER_SCHEMA, WATCH
from eventlake.sources import layers, sample
from eventlake.sources.raw import missing_files as hours_without_file
from eventlake.sources.raw import lines_per_hour, read_lines, read_raw
from eventlake.sources.scratch import scratch_path
from eventlake.streaming import hours

Query = Callable[[SparkSession, str], DataFrame]

def raw(spark: SparkSession, sf: str, redelivered: bool = False) -> DataFrame:
    return sample.envelope(sample.read_events(spark, sf), redelivered)


def raw_spread(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows built in all shuffle partitions, as those of raw files."""
    return sample.envelope(sample.spread(sample.read_events(spark, sf)))


def bronze(spark: SparkSession, sf: str, redelivered: bool = False) -> DataFrame:
    return B.bronze(raw(spark, sf, redelivered))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return S.silver(bronze(spark, sf))


def events(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return S.events(bronze(spark, sf), *columns)


def gated(spark: SparkSession, sf: str) -> DataFrame:
    return S.gate_labels(bronze(spark, sf))


def core(spark: SparkSession, sf: str) -> DataFrame:
    return P.core_projection(raw(spark, sf))


def stored(df: DataFrame, name: str, **options: bool) -> DataFrame:
    """Writes a date layer to scratch space and reads it back."""
    path = scratch_path(df.sparkSession, name)
    layers.write_by_date(df, path, **options)
    return layers.read_layer(df.sparkSession, path)


def raw_files(spark: SparkSession, sf: str, broken: bool = False) -> DataFrame:
    """The events written as gzip JSON lines, a file per hour, and read back."""
    lines = sample.raw_lines(raw_spread(spark, sf))
    if broken:
        lines = sample.break_some_lines(lines)
    path = scratch_path(spark, "raw")
    sample.write_raw_lines(lines, path)
    return read_raw(spark, [f"{path}/*.json.gz"])


def stored_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of redelivered events, written and read back as the jobs do."""
    path = scratch_path(spark, "silver")
    layers.write_by_date(S.silver(bronze(spark, sf, redelivered=True)), path, gather=True)
    return layers.read_layer(spark, path, schema=SILVER_SCHEMA)


def two_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Silver of redelivered events stored as events and labels, each by date."""
    marked = S.silver_marked(bronze(spark, sf, redelivered=True))
    events_path, labels_path = scratch_path(spark, "events"), scratch_path(spark, "labels")
    layers.write_by_date(S.event_table(marked), events_path, gather=True)
    layers.write_by_date(S.label_table(marked), labels_path, gather=True, sort_by=("event_id",))
    return (
        layers.read_layer(spark, events_path, schema=EVENT_SCHEMA),
        layers.read_layer(spark, labels_path, schema=LABEL_SCHEMA),
    )


def silver_view(spark: SparkSession, sf: str) -> DataFrame:
    return S.silver_view(*two_tables(spark, sf))


def event_table(spark: SparkSession, sf: str) -> DataFrame:
    return two_tables(spark, sf)[0]


def grain(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Event grain of stored Silver, the input of Gold."""
    return S.event_grain(stored_silver(spark, sf), *columns)


def stars(spark: SparkSession, sf: str) -> DataFrame:
    starred = stored_silver(spark, sf).filter(F.col("type") == WATCH)
    return G.top_repos_by_stars(S.event_grain(starred, "type", "repo_name"))


def actors(spark: SparkSession, sf: str) -> DataFrame:
    return G.top_actors(grain(spark, sf, "actor_login"))


def by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return G.events_by_hour(grain(spark, sf, "created_at"))


def pushes(spark: SparkSession, sf: str) -> DataFrame:
    pushed = stored_silver(spark, sf).filter(F.col("type") == PUSH)
    return P.push_event_count(S.event_grain(pushed, "type"))


# Sources and sinks


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    return S.flatten(B.bronze(raw_files(spark, sf)))


def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each date as counted by the write and as read back; fails if any value differs."""
    path = scratch_path(spark, "bronze")
    rows, seen = bronze(spark, sf), Observation()
    layers.write_by_date(rows.observe(seen, *Q.content_columns(rows)), path)
    back = layers.read_layer(spark, path, schema=BRONZE_SCHEMA).select(*rows.columns)
    written = Q.Content.of(seen.get)
    Q.require_same_content("bronze rows", written, Q.content(back))
    # One row a date.
    counted = spark.createDataFrame(list(written.by_date.items()), "day string, written long")
    counted = counted.select(F.when(F.col("day") != "", F.col("day").cast("date")).alias("day"), "written")
    stored = back.groupBy("event_date").agg(F.count(F.lit(1)).alias("read_back"))
    both = stored.join(counted, F.col("event_date").eqNullSafe(F.col("day")), "full")
    return both.select(F.coalesce("event_date", "day").alias("event_date"), "written", "read_back")


def gold_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The three Gold tables, made from stored Silver by the job, read back and counted."""
    lake = scratch_path(spark, "lake")
    layers.write_by_date(S.silver(bronze(spark, sf, redelivered=True)), f"{lake}/silver", gather=True)
    measure = {"top_repos_by_stars": "star_count"}
    parts = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(measure.get(name, "event_count")).alias("total"),
        )
        for name, table in jobs.run_gold(spark, lake).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def streamed(spark: SparkSession, sf: str, delay_days: int, redelivered: bool, made) -> tuple[str, DataFrame]:
    """Raw files read as a stream in several batches, and between them a stream over their
    events; its table. Copies of redelivered events come in later files."""
    root = scratch_path(spark, "stream")
    events, out, delay = f"{root}/split", f"{root}/out", f"{delay_days} days"
    once = raw_spread(spark, sf)

    def run() -> DataFrame:
        hours.split_late(spark, f"{root}/raw/*", events, f"{root}/done/split", delay, files_per_batch=300)
        rows = made(hours.event_stream(spark, events, delay))
        hours.append(rows, out, f"{root}/done/out")
        return rows

    sample.write_raw_lines(sample.raw_lines(once), f"{root}/raw/a")
    run()
    if redelivered:
        again = once.filter(F.col("id").cast("bigint") % 10 == 0)
        sample.write_raw_lines(sample.raw_lines(again), f"{root}/raw/b")
    # Moves the watermark past all events, which closes their hours.
    sample.write_heartbeat(once, delay_days + 1, f"{root}/raw/z")
    rows = run()
    return events, spark.read.schema(rows.schema).parquet(out)


def stream_unique_events(spark: SparkSession, sf: str) -> DataFrame:
    _, rows = streamed(spark, sf, 60, True, hours.unique_events)
    return rows.filter(F.col("type") != hours.HEARTBEAT).select(*EVENT_COLUMNS)


def stream_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hours closed by the stream, and the late events that were set aside, added up."""
    events, closed = streamed(spark, sf, 2, False, hours.hour_counts)
    late = G.events_by_date_and_hour(hours.late_events(spark, events))
    both = closed.unionByName(late)
    return both.groupBy("event_date", "hour").agg(F.sum("event_count").alias("event_count"))


def lake_by_day(spark: SparkSession, sf: str, done=lambda lake: None) -> str:
    """Silver of redelivered events, loaded by runs over parts of the dates, later ones
    first; each tenth event is delivered again a day later. ``done`` follows each run."""
    lake = scratch_path(spark, "lake")
    once = raw(spark, sf)
    day_after = F.date_format(
        F.to_timestamp_ntz("created_at", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")) + F.expr("INTERVAL 1 DAY"),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    again = once.filter(F.col("id").cast("bigint") % 10 == 0).withColumn("created_at", day_after)
    layers.write_by_date(B.bronze(once.unionByName(again)), f"{lake}/bronze")
    days = layers.read_layer(spark, f"{lake}/bronze", schema=BRONZE_SCHEMA).agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last")
    ).first()
    if days.first is not None:
        middle = days.first + (days.last - days.first) // 2
        for part in ((middle + timedelta(days=1), days.last), (days.first, middle)):
            jobs.run_silver(spark, lake, *part)
            done(lake)
    return lake


def silver_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return layers.read_layer(spark, f"{lake_by_day(spark, sf)}/silver", schema=SILVER_SCHEMA)


def gold_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Gold kept up after each of these runs: the second moves events to earlier dates."""
    lake = lake_by_day(spark, sf, done=lambda lake: daily.run_gold_by_day(spark, lake))
    parts = [
        jobs.read_gold(spark, lake)[name].select(
            F.lit(name).alias("table_name"), F.col(t.key).cast("string").alias("key"), F.col(t.measure).alias("n")
        )
        for name, t in daily.gold_tables().items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def bronze_layer(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "bronze")
    layers.write_by_date(bronze(spark, sf), path)
    return path


def stored_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return layers.read_layer(spark, bronze_layer(spark, sf), schema=BRONZE_SCHEMA)


def schema_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of payload fields by date, stored by date, compared with the date before."""
    rows = B.bronze(sample.add_payload_field(raw(spark, sf)))
    path = scratch_path(spark, "kinds")
    layers.write_by_date(P.payload_kinds_by_date(stored(rows, "bronze")), path, gather=True, sort_by=("field",))
    kept = layers.read_layer(spark, path, schema="field string, kinds string, event_date date")
    return P.schema_changes(kept)


def partition_layout(spark: SparkSession, sf: str) -> DataFrame:
    return layers.partition_layout(spark, bronze_layer(spark, sf))


def layout_check(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of a layer by its listing, with what a second engine can know of them."""
    path = bronze_layer(spark, sf)
    files = layers.file_layout(spark, path).groupBy("event_date").agg(
        (F.count(F.lit(1)) > 0).alias("has_files"), (F.min("size_mb") > 0).alias("has_data")
    )
    rows = layers.read_layer(spark, path, schema=BRONZE_SCHEMA).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows")
    )
    same = files.event_date.eqNullSafe(rows.event_date)
    return files.join(rows, same).select(files.event_date, "has_files", "has_data", "rows")


def events_on_date(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the last day stored; the scan reads that day's directory only."""
    path = bronze_layer(spark, sf)
    whole = layers.read_layer(spark, path, schema=BRONZE_SCHEMA)
    last = whole.agg(F.max("event_date")).first()[0]
    day = layers.read_layer(spark, path, last, last, BRONZE_SCHEMA)
    return day.select(F.col("id").alias("event_id"), "type", "event_date")


def missing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Hours without a raw file, looked for until two days after the last event."""
    path = scratch_path(spark, "raw")
    sample.write_raw_lines(sample.raw_lines(raw(spark, sf)), path)
    days = bronze(spark, sf).agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    return hours_without_file(spark, path, days.first, days.last + timedelta(days=2)).select("event_date", "hour")


def short_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files that ended too early: of some hours most lines are cut off."""
    path = scratch_path(spark, "raw")
    sample.write_raw_lines(sample.cut_some_hours(sample.raw_lines(raw(spark, sf))), path)
    return Q.short_hours(lines_per_hour(spark, path))


def top_level_fields(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    sample.write_raw_lines(sample.raw_lines(raw(spark, sf)), path)
    return P.top_level_fields(read_lines(spark, [f"{path}/*.json.gz"]))


def unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """What the schema does not know of raw files, kept by Bronze and read back."""
    path = scratch_path(spark, "raw")
    sample.write_raw_lines(sample.add_unknown_fields(sample.raw_lines(raw(spark, sf))), path)
    kept = stored(B.bronze(read_raw(spark, [f"{path}/*.json.gz"])), "bronze")
    return kept.filter(F.col(REST).isNotNull()).select(F.col("id").alias("event_id"), REST)


def record_union_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return P.record_union_kinds(sample.raw_lines(raw(spark, sf)))


def corrupt_count(spark: SparkSession, sf: str) -> DataFrame:
    return B.corrupt_count(raw_files(spark, sf, broken=True))


def silver_with_broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Reconciliation of the Silver rows that remain beside broken lines."""
    readable = stored(B.bronze(raw_files(spark, sf, broken=True)), "bronze")
    return Q.silver_reconcile(S.silver(readable))


def event_grain(spark: SparkSession, sf: str) -> DataFrame:
    """Event grain from stored Silver, the input holding redelivered events."""
    return grain(spark, sf)


def created_at_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return S.flatten(bronze(spark, sf)).select(
        "event_id", "created_at", "event_date", hour_of_day("created_at").alias("hour")
    )


def array_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = P.array_sizes(stored_bronze(spark, sf), ["labels"], "id")
    return sizes.select(
        F.col("id").alias("event_id"), "type", F.col("labels").alias("n_labels")
    )


def label_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Label counts per type before and after the gate."""
    both = bronze(spark, sf).select(
        "type", labels().alias("any"), pr_labels().alias("kept")
    )
    return both.groupBy("type").agg(
        F.coalesce(F.sum(F.array_size("any")), F.lit(0)).alias("labels_in_payload"),
        F.coalesce(F.sum(F.array_size("kept")), F.lit(0)).alias("labels_kept"),
    )


QUERIES: dict[str, Query] = {
    # sources and sinks
    "raw_events": raw_events,
    "bronze_roundtrip": bronze_roundtrip,
    "gold_roundtrip": gold_roundtrip,
    "partition_layout": partition_layout,
    "layout_check": layout_check,
    "missing_files": missing_files,
    "short_hours": short_hours,
    "events_on_date": events_on_date,
    "corrupt_count": corrupt_count,
    "unknown_fields": unknown_fields,
    "top_level_fields": top_level_fields,
    "missing_hours": lambda s, d: Q.missing_hours(S.flatten(bronze(s, d))),
    "missing_hours_by_actor": lambda s, d: Q.missing_hours_by(S.flatten(bronze(s, d)), "actor_login"),
    # projections and scalar functions
    "nested_select": lambda s, d: P.nested_select(raw(s, d)),
    "core_projection": lambda s, d: core(s, d).select(
        "*", F.col("org.login").alias("org_login")
    ).drop("org"),
    "created_at_parsed": created_at_parsed,
    "array_sizes": array_sizes,
    # Silver
    "silver_flat": lambda s, d: S.flatten(bronze(s, d)),
    "label_gate": label_gate,
    "silver_exploded": lambda s, d: S.explode_labels(gated(s, d)),
    "labels_inner": lambda s, d: S.labels_inner(gated(s, d)),
    "silver": lambda s, d: S.silver(bronze(s, d, redelivered=True)),
    "event_grain": event_grain,
    "event_rows": lambda s, d: S.events(bronze(s, d, redelivered=True)),
    "rows_with_label": lambda s, d: Q.rows_with_label(silver(s, d)),
    "label_types": lambda s, d: Q.label_types(silver(s, d)),
    "label_sample": lambda s, d: Q.label_sample(silver(s, d)),
    "silver_reconcile": lambda s, d: Q.silver_reconcile(silver(s, d)),
    "silver_with_broken_lines": silver_with_broken_lines,
    "label_row_expectation": lambda s, d: Q.label_row_expectation(
        S.gate_labels(bronze(s, d, redelivered=True)), stored_silver(s, d)
    ),
    "silver_by_day": silver_by_day,
    "silver_view": silver_view,
    "event_table": event_table,
    "stream_unique_events": stream_unique_events,
    "stream_hours": stream_hours,
    # Gold and findings
    "gold_by_day": gold_by_day,
    "top_repos_by_stars": stars,
    "events_by_hour": by_hour,
    "events_by_date_and_hour": lambda s, d: G.events_by_date_and_hour(
        events(s, d, "event_date", "created_at")
    ),
    "top_actors": actors,
    "top_repos_by_events": lambda s, d: G.top_repos_by_events(events(s, d, "repo_name")),
    "hour_peak_quiet": lambda s, d: G.hour_peak_quiet(by_hour(s, d)),
    "top10_repos": lambda s, d: G.first_repos(stars(s, d)),
    "top10_actors": lambda s, d: G.first_actors(actors(s, d)),
    "non_bot_of_top": lambda s, d: G.non_bot_of_top(actors(s, d)),
    "top_non_bot_actors": lambda s, d: G.top_non_bot_actors(events(s, d, "actor_login")),
    # profiling
    "total_events": lambda s, d: P.total_events(core(s, d)),
    "events_by_type": lambda s, d: P.events_by_type(core(s, d)),
    "push_event_count": pushes,
    "type_share": lambda s, d: P.type_share(core(s, d)),
    "actor_share": lambda s, d: P.actor_share(grain(s, d, "actor_login")),
    "duplicate_ids": lambda s, d: P.duplicate_ids(
        P.core_projection(raw(s, d, redelivered=True))
    ),
    "distinct_event_count": lambda s, d: P.distinct_event_count(
        S.flatten(bronze(s, d, redelivered=True))
    ),
    "actor_group_count": lambda s, d: P.group_count(
        events(s, d, "actor_login"), "actor_login"
    ),
    "created_at_range": lambda s, d: P.created_at_range(core(s, d)),
    "public_counts": lambda s, d: P.public_counts(core(s, d)),
    "org_null_ratio": lambda s, d: P.org_null_ratio(core(s, d)),
    "cardinalities": lambda s, d: P.cardinalities(core(s, d)),
    "payload_keys_by_type": lambda s, d: P.payload_keys_by_type(stored_bronze(s, d)),
    "payload_union_schema": lambda s, d: P.payload_union_schema(stored_bronze(s, d)),
    "record_union_kinds": record_union_kinds,
    "payload_field_kinds": lambda s, d: P.payload_field_kinds(stored_bronze(s, d)),
    "schema_changes": schema_changes,
    "payload_field_presence": lambda s, d: P.payload_field_presence(stored_bronze(s, d)),
    "missing_payload_fields": lambda s, d: Q.missing_payload_fields(stored_bronze(s, d)),
    "array_size_stats": lambda s, d: P.array_size_stats(stored_bronze(s, d)),
    "array_field_profile": lambda s, d: P.array_field_profile(stored_bronze(s, d)),
    # skew
    "key_skew_report": lambda s, d: Q.key_skew_report(grain(s, d, "actor_login")),
    "key_skew_by_digest": lambda s, d: Q.key_skew_report(
        grain(s, d, "actor_login"),
        hashed=F.conv(F.substring(F.md5("actor_login"), 1, 8), 16, 10).cast("bigint"),
    ),
    "heaviest_key": lambda s, d: Q.heaviest_key(grain(s, d, "actor_login")),
}
