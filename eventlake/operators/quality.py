"""Completeness, reconciliation and skew reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.functions.payload import key_seen, keys
from eventlake.functions.timestamps import hour_of_day
from eventlake.operators.bronze import in_dates
from eventlake.operators.keep import count_by, top
from eventlake.schema import PAYLOAD_FIELDS, PULL_REQUEST


class CheckFailed(RuntimeError):
    """A layer does not agree with the layer it was made from."""


def require_equal(what: str, expected: int, actual: int) -> None:
    if expected != actual:
        raise CheckFailed(f"{what}: expected {expected}, found {actual}")


#: Dates whose rows are counted exactly in one pass; with more, totals and digest remain.
DATES_COUNTED = 20_000


@dataclass(frozen=True)
class Content:
    """What a layer holds: rows, an order-free digest of all values, rows by date ('': none)."""

    rows: int
    digest: int
    by_date: dict[str, int]

    @staticmethod
    def of(row: Mapping) -> Content:
        dates = {item: n for item, n in row["dates"] or [] if item is not None}
        return Content(int(row["rows"]), int(row["digest"] or 0), dates)


def content_columns(df: DataFrame) -> list[Column]:
    """Aggregates for ``Content``, for ``agg`` and ``observe`` alike.

    The digest is a sum over rows, so neither order nor the tasks matter, and repeated
    rows count. A row is hashed as JSON with the names of its fields: a value that moves
    to another column, or a row that moves to another date, changes it.
    """
    whole = F.to_json(F.struct(*sorted(df.columns)))
    date_text = F.coalesce(F.col("event_date").cast("string"), F.lit(""))
    # Exact as long as there are fewer dates than the sketch has room for.
    counts = F.call_function("approx_top_k", date_text, F.lit(DATES_COUNTED // 2), F.lit(DATES_COUNTED))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(whole).cast("decimal(20,0)")).alias("digest"),
        counts.alias("dates"),
    ]


def content(df: DataFrame) -> Content:
    return Content.of(df.agg(*content_columns(df)).first().asDict())


def require_same_content(what: str, written: Content, stored: Content) -> None:
    require_equal(what, written.rows, stored.rows)
    for day in sorted(written.by_date.keys() | stored.by_date.keys()):
        require_equal(f"{what} on {day or 'no date'}", written.by_date.get(day, 0), stored.by_date.get(day, 0))
    if written.digest != stored.digest:
        raise CheckFailed(f"{what}: {written.rows} rows as expected, but other values")


def silver_reconcile(silver: DataFrame) -> DataFrame:
    """Rows, distinct events, labelled rows and the surplus rows labels cause.

    A NULL event_id counts as one event. Rows are first reduced per event inside
    each task; one shuffle by event_id.
    """
    per_event = silver.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("pr_label_name").alias("labelled")
    )
    rows, events = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return per_event.agg(
        rows.alias("rows"),
        events.alias("distinct_events"),
        F.coalesce(F.sum("labelled"), F.lit(0)).alias("rows_with_label"),
        (rows - events).alias("surplus_rows"),
    )


def rows_with_label(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("pr_label_name").isNotNull()).agg(
        F.count(F.lit(1)).alias("rows_with_label")
    )


def label_types(silver: DataFrame) -> DataFrame:
    """Event types behind the labelled rows; anything but pull requests is a leak."""
    return count_by(silver.filter(F.col("pr_label_name").isNotNull()), "type")


def label_sample(silver: DataFrame, n: int = 10) -> DataFrame:
    return (
        silver.filter(F.col("pr_label_name").isNotNull())
        .select("event_id", "repo_name", "pr_label_name", "pr_label_color")
        .orderBy("event_id", "pr_label_name")
        .limit(n)
    )


def label_row_expectation(gated: DataFrame, silver: DataFrame) -> DataFrame:
    """Label rows predicted from the arrays of ``gated`` events against those in Silver.

    The first three columns are of the arrays as they come, copies included.
    ``distinct_label_rows`` is the prediction: names in an event, repeats and NULL names
    apart, over its copies of the earliest date. ``actual_rows`` counts labelled Silver
    rows of any type, so a leak shows as a difference. Equal arrays of an event collapse
    inside each task.
    """
    pulls = gated.filter(F.col("type") == PULL_REQUEST)
    names = F.filter(F.transform("pr_labels", lambda x: x["name"]), lambda n: n.isNotNull())
    size = F.array_size("pr_labels")
    filled = F.when(size > 0, size)
    arrays = pulls.agg(
        F.count(filled).alias("events_with_labels"),
        F.round(F.avg(filled), 4).alias("avg_labels"),
        F.coalesce(F.sum(filled), F.lit(0)).alias("expected_rows"),
    )
    by_date = pulls.groupBy("event_id", "event_date").agg(F.collect_set(names).alias("names"))
    day = F.struct(F.col("event_date").isNull().alias("undated"), "event_date", "names")
    first = by_date.groupBy("event_id").agg(F.min(day).alias("first"))
    predicted = first.agg(
        F.coalesce(
            F.sum(F.size(F.array_distinct(F.flatten("first.names")))), F.lit(0)
        ).alias("distinct_label_rows")
    )
    actual = rows_with_label(silver).withColumnRenamed("rows_with_label", "actual_rows")
    parts = arrays.unionByName(predicted, allowMissingColumns=True)
    parts = parts.unionByName(actual, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def missing_payload_fields(
    raw: DataFrame, expected: Sequence[str] = PAYLOAD_FIELDS
) -> DataFrame:
    """Expected payload fields that no record has."""
    # One flag per expected name, so each task hands on a single row.
    flags = F.array(
        *(F.struct(F.lit(n).alias("field"), key_seen("keys", n).alias("seen")) for n in expected)
    )
    report = raw.select(keys().alias("keys")).agg(flags.alias("flags"))
    absent = F.filter("flags", lambda f: ~f["seen"])
    return report.select(F.inline(absent)).select("field")


def hour_manifest(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every hour of every day of an inclusive range, with its raw file name.

    The hour in the file name has no leading zero.
    """
    if end < start:
        raise ValueError(f"end {end} lies before start {start}")
    day = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("event_date")
    )
    return _with_hours(day).withColumn(
        "file_name",
        F.concat(
            F.col("event_date").cast("string"), F.lit("-"),
            F.col("hour").cast("string"), F.lit(".json.gz"),
        ),
    )


def _with_hours(days: DataFrame) -> DataFrame:
    return days.select(
        "event_date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    )


def missing_hours(
    events: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Hours of the range in which no event happened.

    Without a range, from the first to the last day seen.
    """
    stamp = F.col("created_at")
    present = events.select(
        stamp.cast("date").alias("event_date"), hour_of_day(stamp).alias("hour")
    )
    present = present.filter(in_dates(start, end) & F.col("event_date").isNotNull()).distinct()
    if start is not None and end is not None:
        wanted = hour_manifest(events.sparkSession, start, end).drop("file_name")
        return wanted.join(present, ["event_date", "hour"], "left_anti")
    bounds = present.agg(
        (F.lit(start) if start else F.min("event_date")).alias("first"),
        (F.lit(end) if end else F.max("event_date")).alias("last"),
    )
    days = F.explode(F.sequence("first", "last")).alias("event_date")
    wanted = _with_hours(bounds.select(days))
    return wanted.join(present, ["event_date", "hour"], "left_anti")


def short_hours(counts: DataFrame, around: int = 12, share: float = 0.5) -> DataFrame:
    """Hours that are there but hold less than ``share`` of the usual: of the median over
    the hours up to ``around`` before and after, their own included.

    ``counts`` (event_date, hour, lines) has a row for each hour with a file, 24 a day at
    most, so one task can hold them; hours without a file are ``missing_files``.
    """
    number = F.unix_date("event_date") * 24 + F.col("hour")
    near = Window.orderBy("number").rangeBetween(-around, around)
    # At most 2 * around + 1 values; a percentile takes no frame.
    values = F.sort_array(F.collect_list("lines").over(near))
    with_values = counts.withColumn("number", number).withColumn("near", values)
    middle = [F.get("near", F.floor((F.size("near") - 1 + i) / 2).cast("int")) for i in (0, 1)]
    with_median = with_values.withColumn("usual", (middle[0] + middle[1]) / 2)
    return with_median.filter(F.col("lines") < share * F.col("usual")).select("event_date", "hour", "lines", "usual")


def missing_hours_by(events: DataFrame, key: str) -> DataFrame:
    """For each value of ``key``, hours without an event between its first and last day.

    One pass over the events: distinct hours per key, at most 24 a day.
    """
    stamp = F.col("created_at")
    seen = (
        events.filter(stamp.isNotNull())
        .groupBy(key, stamp.cast("date").alias("event_date"))
        .agg(F.collect_set(hour_of_day(stamp)).alias("hours"))
    )
    days = seen.groupBy(key).agg(
        F.min("event_date").alias("first"),
        F.max("event_date").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("event_date", "hours"))).alias("seen"),
    )
    each = days.select(key, "seen", F.explode(F.sequence("first", "last")).alias("event_date"))
    got = F.coalesce(F.element_at("seen", F.col("event_date")), F.array().cast("array<int>"))
    wanted = F.sequence(F.lit(0), F.lit(23))
    return each.select(key, "event_date", F.explode(F.array_except(wanted, got)).alias("hour"))


def key_skew_report(
    events: DataFrame,
    key: str = "actor_login",
    buckets: int = 8,
    hashed: Column | None = None,
) -> DataFrame:
    """Keys, rows and largest key per hash bucket.

    Buckets are computed from the key's hash, the way a shuffle assigns rows to that
    many partitions, so the report does not depend on how the job itself ran. Another
    integer hash of the key may be given.
    """
    counts = count_by(events, key, name="rows")
    hashed = F.hash(key) if hashed is None else hashed
    return (
        counts.withColumn("bucket", F.pmod(hashed, F.lit(buckets)))
        .groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("rows").alias("rows"),
            F.max("rows").alias("largest_key_rows"),
        )
        .orderBy("bucket")
    )


def heaviest_key(events: DataFrame, key: str = "actor_login") -> DataFrame:
    return top(count_by(events, key), 1, "event_count", key)
