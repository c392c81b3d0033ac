from __future__ import annotations

import datetime as dt
import itertools

import pytest
from builders import event, label, pull, write_hour
from pyspark.sql import functions as F

from eventlake.plans import daily, jobs
from eventlake.sources import ids, layers, manifest
from eventlake.sources.raw import raw_glob

DAYS = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
HOURS = {
    "2024-01-30-5.json.gz": [event(f"a{i}", at="2024-01-30T05:00:00Z", login=f"u{i % 3}") for i in range(6)]
    + [pull("p", label("x"), label("y"), at="2024-01-30T05:30:00Z")],
    "2024-01-31-0.json.gz": [event(f"w{i}", type="WatchEvent", at="2024-01-31T00:00:01Z", repo=f"r{i % 2}") for i in range(5)]
    + [event("a1", at="2024-01-31T05:00:00Z", login="u1"), pull("p", label("z"), at="2024-01-31T00:30:00Z")],
    "2024-02-01-7.json.gz": [event(f"b{i}", at="2024-02-01T07:00:00Z", login="u9") for i in range(4)]
    + [event("w0", type="WatchEvent", at="2024-02-01T07:00:00Z", repo="r0"), event(None, at="2024-02-01T08:00:00Z")],
}


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def gold(spark, lake):
    return {n: table(t) for n, t in jobs.read_gold(spark, lake).items()}


@pytest.fixture()
def raw(folder):
    for name, lines in HOURS.items():
        write_hour(folder, name, lines)
    return folder


def load(spark, raw, lake, day, buckets=4):
    jobs.run_bronze(spark, [raw_glob(raw, day, day)], lake, day, day)
    jobs.run_silver(spark, lake, day, day, buckets=buckets)


@pytest.mark.parametrize("order", [DAYS, DAYS[::-1], [DAYS[1], DAYS[2], DAYS[0]]])
def test_gold_by_day_is_gold_of_all(spark, raw, order):
    whole, lake = f"{raw}/whole", f"{raw}/lake"
    jobs.run_all(spark, [f"{raw}/*.json.gz"], whole)
    for day in order:
        load(spark, raw, lake, day)
        daily.run_gold_by_day(spark, lake)
        by_day = gold(spark, lake)
        jobs.run_gold(spark, lake)
        assert gold(spark, lake) == by_day
    assert by_day == gold(spark, whole)


def test_only_changed_dates_are_read(spark, raw):
    lake = f"{raw}/lake"
    for day in DAYS:
        load(spark, raw, lake, day)
    daily.run_gold_by_day(spark, lake)
    noted = f"{lake}/gold_counts/made_from"
    assert manifest.changes(spark, f"{lake}/silver", noted).days == frozenset()
    before = {p: layers.date_files(spark, f"{lake}/gold_counts/{p}/top_actors") for p in ("day", "month")}
    # The same day again, with one event less.
    write_hour(raw, "2024-02-01-7.json.gz", HOURS["2024-02-01-7.json.gz"][1:])
    load(spark, raw, lake, DAYS[2])
    assert manifest.changes(spark, f"{lake}/silver", noted).days == {DAYS[2]}
    daily.run_gold_by_day(spark, lake)
    after = {p: layers.date_files(spark, f"{lake}/gold_counts/{p}/top_actors") for p in ("day", "month")}
    assert [d for d in DAYS if before["day"][d] != after["day"][d]] == [DAYS[2]]
    january, february = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert before["month"][january] == after["month"][january] and before["month"][february] != after["month"][february]
    assert ("u9", 3) in gold(spark, lake)["top_actors"]


def test_an_event_that_moves_changes_both_dates(spark, raw):
    lake = f"{raw}/lake"
    load(spark, raw, lake, DAYS[1])
    load(spark, raw, lake, DAYS[2])
    daily.run_gold_by_day(spark, lake)
    load(spark, raw, lake, DAYS[0])
    # a1 and p belong to the first day now, so the second was written again.
    found = manifest.changes(spark, f"{lake}/silver", f"{lake}/gold_counts/made_from")
    assert found.days == {DAYS[0], DAYS[1]}


def test_an_interrupted_run_is_made_good(spark, raw, monkeypatch):
    lake = f"{raw}/lake"
    load(spark, raw, lake, DAYS[0])
    daily.run_gold_by_day(spark, lake)
    load(spark, raw, lake, DAYS[1])
    real, calls = daily.refresh, itertools.count()

    def dies(*args):
        if next(calls) == 1:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(daily, "refresh", dies)
    with pytest.raises(OSError):
        daily.run_gold_by_day(spark, lake)
    monkeypatch.undo()
    daily.run_gold_by_day(spark, lake)
    by_day = gold(spark, lake)
    jobs.run_gold(spark, lake)
    assert gold(spark, lake) == by_day


def test_dates_that_disappear_and_undated_events(spark, raw):
    lake = f"{raw}/lake"
    write_hour(raw, "2024-01-30-6.json.gz", [event("n", at="junk", login="nobody")])
    jobs.run_all(spark, [f"{raw}/*.json.gz"], lake)
    daily.run_gold_by_day(spark, lake)
    assert ("nobody", 1) in gold(spark, lake)["top_actors"]
    write_hour(raw, "2024-02-01-7.json.gz", [])
    load(spark, raw, lake, DAYS[2])
    daily.run_gold_by_day(spark, lake)
    by_day = gold(spark, lake)
    jobs.run_gold(spark, lake)
    assert gold(spark, lake) == by_day and "u9" not in {k for k, _ in by_day["top_actors"]}
    assert ("nobody", 1) in by_day["top_actors"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_reads_the_directories_of_the_dates(spark, raw):
    lake = f"{raw}/lake"
    for day in DAYS:
        load(spark, raw, lake, day)
    for t in daily.gold_tables().values():
        plan = plan_of(t.counts(daily.silver_of(spark, lake, {DAYS[2]})))
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in scans]
        assert filters and all("event_date" in f and "2024-02-01" in f for f in filters)


def test_the_stored_side_of_the_index_is_not_shuffled(spark, raw):
    lake = f"{raw}/lake"
    for day in DAYS:
        load(spark, raw, lake, day)
    index = ids.IdIndex(spark, lake, 4)
    assert index.refresh() == frozenset()
    held = {(r.id_key, r.event_date) for r in index.rows().collect()}
    silver = layers.read_layer(spark, f"{lake}/silver").select("event_id", "event_date").distinct().collect()
    assert held == {("" if r.event_id is None else f"={r.event_id}", r.event_date) for r in silver}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        new = layers.read_layer(spark, f"{lake}/silver").filter(F.col("event_date") == DAYS[2])
        plan = plan_of(ids.not_in(new, index.rows().filter(F.col("event_date") < F.lit(DAYS[2]))))
        # One exchange, that of the new rows; the index is read in its buckets.
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        scans = [line for line in plan.splitlines() if "eventlake_ids" in line]
        assert scans and all("PartitionFilters" in line and "2024-02-01" in line for line in scans)
        again = plan_of(jobs.held_again(index.rows(), DAYS[0], DAYS[0]))
        below = again[: again.index("SortMergeJoin")], again[again.index("SortMergeJoin") :]
        assert "Exchange" not in below[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_index_that_lags_behind_is_refreshed(spark, raw):
    lake = f"{raw}/lake"
    jobs.run_all(spark, [f"{raw}/*.json.gz"], lake)  # a full run keeps no index
    index = ids.IdIndex(spark, lake, 4)
    assert index.refresh() == set(DAYS)
    layers.write_by_date(
        layers.read_layer(spark, f"{lake}/silver").filter(F.col("event_date") == DAYS[0]).limit(0), f"{lake}/silver",
        only=lambda d: d == DAYS[0],
    )
    assert index.refresh() == {DAYS[0]}
    assert {r.event_date for r in index.rows().collect()} == set(DAYS[1:])
    # Another number of buckets is another index.
    assert ids.IdIndex(spark, lake, 3).refresh() == set(DAYS[1:])


def test_a_lake_without_events(spark, folder):
    write_hour(folder, "2024-01-30-5.json.gz", ["{broken"])
    lake = f"{folder}/lake"
    load(spark, folder, lake, DAYS[0])
    for _ in range(2):
        assert all(t.count() == 0 for t in daily.run_gold_by_day(spark, lake).values())
    write_hour(folder, "2024-01-31-0.json.gz", [event("1", at="2024-01-31T05:00:00Z")])
    load(spark, folder, lake, DAYS[1])
    assert daily.run_gold_by_day(spark, lake)["top_actors"].count() == 1


def test_quoted_path(spark, folder):
    lake = f"{folder}/it's"
    write_hour(folder, "2024-01-30-5.json.gz", HOURS["2024-01-30-5.json.gz"])
    load(spark, folder, lake, DAYS[0])
    load(spark, folder, lake, DAYS[0])
    assert ids.IdIndex(spark, lake, 4).refresh() == frozenset()
