from __future__ import annotations

import datetime as dt
import os

import pytest
from builders import event, write_hour
from pyspark.sql import functions as F

from eventlake.operators import gold as G
from eventlake.streaming import hours

DAY = dt.date(2024, 1, 1)


@pytest.fixture()
def spark(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Lake:
    """A folder of raw files and what the streams made of it."""

    def __init__(self, spark, folder, delay, made):
        self.spark, self.folder, self.delay, self.made = spark, folder, delay, made
        self.raw, self.files = f"{folder}/raw", 0
        os.makedirs(self.raw)

    def add(self, hour, *events):
        write_hour(self.raw, f"2024-01-01-{hour}.json.gz", list(events))
        path = f"{self.raw}/2024-01-01-{hour}.json.gz"
        self.files += 1
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))

    def run(self, files_per_batch=24):
        hours.split_late(self.spark, self.raw, f"{self.folder}/split", f"{self.folder}/c1", self.delay, files_per_batch)
        rows = self.made(hours.event_stream(self.spark, f"{self.folder}/split", self.delay))
        hours.append(rows, f"{self.folder}/out", f"{self.folder}/c2")
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/out")

    def late(self):
        return hours.late_events(self.spark, f"{self.folder}/split")


def at(hour, minute=0, day=1):
    return f"2024-01-{day:02d}T{hour:02d}:{minute:02d}:00Z"


def test_each_event_once_over_restarts(spark, folder):
    lake = Lake(spark, folder, "3 hours", hours.unique_events)
    lake.add(1, event("a", at=at(1)), event("b", at=at(1)), event("a", at=at(1)), event(None, at=at(1)))
    assert sorted(str(r.event_id) for r in lake.run().collect()) == ["None", "a", "b"]
    # The next run starts from the checkpoint and knows the ids.
    lake.add(2, event("b", at=at(1)), event("c", at=at(2)), event(None, at=at(2)))
    lake.add(3, event("c", at=at(2)), event("d", at=at(3)))
    assert sorted(str(r.event_id) for r in lake.run(files_per_batch=1).collect()) == ["None", "a", "b", "c", "d"]
    assert lake.run().count() == 5
    assert lake.late().count() == 0


def test_closed_hours_and_late_events_are_all_events(spark, folder, any_zone):
    lake = Lake(spark, folder, "2 hours", hours.hour_counts)
    everything = []

    def add(name, *events):
        everything.extend(events)
        lake.add(name, *events)

    add(1, event("1", at=at(1)), event("2", at=at(1, 59)), event("3", at=at(2, 30)))
    add(2, event("4", at=at(6, 10)), event("5", at=at(4, 10)))
    lake.run()
    # 04:10 is the limit now: the first is late, the second is not; one has no time at all.
    add(3, event("6", at=at(4, 10)), event("7", at=at(4, 11)), event("8", at="junk"), event("9", at=at(1)))
    assert {(r.hour, r.event_count) for r in lake.run().collect()} == {(1, 2), (2, 1)}
    assert sorted(r.event_id for r in lake.late().collect()) == ["6", "8", "9"]
    lake.add(4, event("beat", type=hours.HEARTBEAT, at=at(1, day=3)))
    closed = lake.run()
    counts = {(r.event_date, r.hour): r.event_count for r in closed.collect()}
    assert counts == {(DAY, 1): 2, (DAY, 2): 1, (DAY, 4): 2, (DAY, 6): 1}
    late = {(r.event_date, r.hour): r.event_count for r in G.events_by_date_and_hour(lake.late()).collect()}
    assert late == {(DAY, 4): 1, (None, None): 1, (DAY, 1): 1}
    assert sum(counts.values()) + sum(late.values()) == len(everything)


def test_a_batch_that_runs_again_decides_the_same(spark, folder):
    lake = Lake(spark, folder, "1 hour", hours.unique_events)
    lake.add(1, event("a", at=at(5)))
    lake.run()
    lake.add(2, event("b", at=at(9)), event("c", at=at(4)))
    lake.run()
    before = sorted((r.event_id) for r in lake.late().collect())
    # Batches after this one do not count: their newest event is not looked at.
    assert hours._newest_before(spark, f"{folder}/split", 1) < hours._newest_before(spark, f"{folder}/split", 2)
    # As if the driver had died before the commit of the last batch.
    for name in os.listdir(f"{folder}/c1/commits"):
        if name.strip(".").startswith("1"):
            os.remove(f"{folder}/c1/commits/{name}")
    lake.run()
    assert sorted(r.event_id for r in lake.late().collect()) == before == ["c"]
    events = spark.read.parquet(f"{folder}/split/events")
    assert events.groupBy("event_id").count().filter(F.col("count") > 1).count() == 0


def test_broken_lines_are_left_out(spark, folder):
    lake = Lake(spark, folder, "1 hour", hours.unique_events)
    lake.add(1, "{broken", event("a", at=at(5)))
    assert [r.event_id for r in lake.run().collect()] == ["a"] and lake.late().count() == 0
