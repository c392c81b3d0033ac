"""Streams of events: each event once, events per hour, late events set aside.

``split_late`` reads new raw files and decides for each event whether it comes in time:
an event is late if it is not newer than the newest event of all earlier batches less the
delay. Late and undated events go to a table of their own, the others to one that further streams
read, whole batches at a time. There the same delay as a watermark drops nothing, so
what a stream counts and what was set aside add up to all events.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.bronze import bronze
from eventlake.operators.keep import shared
from eventlake.operators.silver import flatten
from eventlake.schema import EVENT_COLUMNS, EVENT_SCHEMA
from eventlake.sources.scratch import file_store
from eventlake.streaming.ingest import BATCH, new_raw_lines, write_batch

#: Time as an instant: watermarks need one. It does not depend on the session's zone.
MOMENT = "moment"
#: An event of this type only moves the time on, so that the last hours are closed.
HEARTBEAT = "Heartbeat"


def _instant(stamp: str = "created_at") -> Column:
    """The instant of a UTC wall clock."""
    days = F.unix_date(F.col(stamp).cast("date")).cast("long")
    seconds = F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)
    return F.timestamp_seconds(days * 86400 + seconds)


def split_late(
    spark: SparkSession, folder: str, target: str, checkpoint: str, delay: str, files_per_batch: int = 24
) -> StreamingQuery:
    """Reads everything new under ``folder`` once: ``target/events`` and ``target/late``.

    Broken lines are left to ``ingest``. A batch replaces what it wrote itself, so one
    that is run again after a failure leaves nothing twice and decides the same again.
    """

    def store(rows: DataFrame, number: int) -> None:
        events = flatten(bronze(rows.drop("source_file"))).withColumn(MOMENT, _instant())
        before = _newest_before(spark, target, number)
        limit = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.col(MOMENT).isNull() | F.coalesce(F.col(MOMENT) <= limit, F.lit(False))
        with shared(events) as kept:
            write_batch(kept.filter(~late), number, f"{target}/events")
            write_batch(kept.filter(late), number, f"{target}/late")
            write_batch(kept.agg(F.max(MOMENT).alias("newest")), number, f"{target}/newest")

    query = (
        new_raw_lines(spark, folder, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _newest_before(spark: SparkSession, target: str, number: int) -> datetime | None:
    """The newest event of the batches before this one; one row a batch is read."""
    where, store = file_store(spark, f"{target}/newest")
    if not store.exists(where):
        return None
    rows = spark.read.schema(f"newest timestamp, {BATCH} long").parquet(f"{target}/newest")
    return rows.filter(F.col(BATCH) < number).agg(F.max("newest")).first()[0]


def late_events(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(f"{EVENT_SCHEMA}, {MOMENT} timestamp").parquet(f"{target}/late").select(*EVENT_COLUMNS)


def event_stream(spark: SparkSession, target: str, delay: str) -> DataFrame:
    """The events that came in time, with the watermark of the delay.

    A run takes all that is there: part of a batch would move the watermark past the
    rest of it. So it is to run between the runs of ``split_late``, not during one.
    """
    events = spark.readStream.schema(f"{EVENT_SCHEMA}, {MOMENT} timestamp").parquet(f"{target}/events")
    return events.withWatermark(MOMENT, delay)


def unique_events(events: DataFrame) -> DataFrame:
    """The first copy of each event, copies being at most the delay apart.

    The state holds the ids of that time only.
    """
    return events.dropDuplicatesWithinWatermark(["event_id"])


def hour_counts(events: DataFrame) -> DataFrame:
    """Events per hour, each hour once and for all when the watermark has passed its end."""
    second = F.unix_seconds("of.start")
    # Heartbeats are left out of the sum, not filtered: the optimizer would move the filter
    # below the watermark, which would then not see them.
    n = F.count_if(~F.col("type").eqNullSafe(HEARTBEAT)).alias("event_count")
    return events.groupBy(F.window(MOMENT, "1 hour").alias("of")).agg(n).filter("event_count > 0").select(
        F.date_from_unix_date(F.floor(second / 86400).cast("int")).alias("event_date"),
        (F.pmod(second, F.lit(86400)) / 3600).cast("int").alias("hour"),
        "event_count",
    )


def append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs a stream over all that is new and adds its rows to a table."""
    query = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
