from __future__ import annotations

import datetime as dt

import pytest
from builders import event, label, pull, write_hour
from pyspark.sql import functions as F

from eventlake.__main__ import parse_args, run
from eventlake.operators import quality as Q
from eventlake.operators.keep import shared
from eventlake.operators.quality import CheckFailed
from eventlake.plans import jobs
from eventlake.sources.layers import read_layer
from eventlake.sources.raw import raw_glob, read_raw
from eventlake.streaming.ingest import ingest_new_files, store_batch

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture()
def raw(folder):
    path = f"{folder}/raw"
    import os

    os.makedirs(path)
    stars = [event(f"s{i}", type="WatchEvent", login=f"u{i % 3}", repo=f"r{i % 2}") for i in range(6)]
    write_hour(path, "2024-01-01-5.json.gz", [*stars, pull("p1", label("x"), label("y"), login="u0"), event("d")])
    write_hour(path, "2024-01-01-6.json.gz", [event("d"), event("junk", at="junk"), "{broken", event("n", at="2024-01-01T06:00:00Z", login="x[bot]")])
    write_hour(path, "2024-01-02-0.json.gz", [event("t", at="2024-01-02T00:00:00Z")])
    return path


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_raw_to_findings(spark, raw, folder, any_zone):
    lake = f"{folder}/lake"
    found = jobs.run_all(spark, [f"{raw}/*.json.gz"], lake)
    assert [tuple(r) for r in found["top10_repos"].collect()] == [("r0", 3), ("r1", 3)]
    assert table(found["hours"]) == [(0, 1), (5, 8), (6, 1), (None, 1)]
    assert tuple(found["hour_peak_quiet"].first())[:2] == (5, 8)
    assert found["top10_actors"].first().actor_login == "ann"
    assert "x[bot]" not in {r.actor_login for r in found["non_bot_of_top"].collect()}
    assert spark.read.parquet(f"{lake}/quarantine/range=first_last").count() == 1


def test_counts_of_silver(spark, raw, folder):
    lake = f"{folder}/lake"
    assert jobs.run_bronze(spark, [f"{raw}/*.json.gz"], lake) == {"lines": 13, "broken": 1, "kept": 12}
    assert jobs.run_silver(spark, lake) == {
        "rows": 12, "distinct_events": 11, "rows_with_label": 2, "surplus_rows": 1,
    }


def test_rerunning_changes_nothing(spark, raw, folder):
    lake = f"{folder}/lake"
    before = None
    for _ in range(2):
        jobs.run_all(spark, [f"{raw}/*.json.gz"], lake)
        now = {n: table(t) for n, t in jobs.read_gold(spark, lake).items()}
        now["silver"] = table(read_layer(spark, f"{lake}/silver"))
        assert before in (None, now)
        before = now


def test_a_dated_run_replaces_its_days_only(spark, raw, folder):
    lake = f"{folder}/lake"
    jobs.run_bronze(spark, [f"{raw}/*.json.gz"], lake)
    jobs.run_silver(spark, lake)
    write_hour(raw, "2024-01-02-1.json.gz", [event("late", at="2024-01-02T01:00:00Z"), event("stray")])
    counts = jobs.run_bronze(spark, [raw_glob(raw, D2, D2)], lake, D2, D2)
    assert counts == {"lines": 3, "broken": 0, "kept": 2}
    jobs.run_silver(spark, lake, D2, D2)
    for layer, key in (("bronze", "id"), ("silver", "event_id")):
        stored = read_layer(spark, f"{lake}/{layer}")
        assert {r[0] for r in stored.filter(F.col("event_date") == D2).select(key).collect()} == {"t", "late"}
        assert stored.filter(F.col("event_date") == D1).select(key).distinct().count() == 9
        assert stored.filter("event_date IS NULL").count() == 1
    aside = spark.read.parquet(f"{lake}/quarantine/range=2024-01-02_2024-01-02")
    assert [r.id for r in aside.collect()] == ["stray"]


TWO_DAYS = {
    "2024-01-01-5.json.gz": [*(event(f"a{i}") for i in range(4)), event("both"), pull("p", label("x"))],
    "2024-01-02-5.json.gz": [
        *(event(f"b{i}", login="bob", at="2024-01-02T05:00:00Z") for i in range(2)),
        event("both", at="2024-01-02T05:00:00Z"),
        pull("p", label("x"), label("later"), at="2024-01-02T05:00:00Z"),
    ],
}


@pytest.mark.parametrize("order", [[D1, D2], [D2, D1], [D1, D2, D1, D2]])
def test_runs_by_day_give_what_one_run_gives(spark, folder, order):
    for name, lines in TWO_DAYS.items():
        write_hour(folder, name, lines)
    whole, daily = f"{folder}/whole", f"{folder}/daily"
    jobs.run_all(spark, [f"{folder}/*.json.gz"], whole)
    for day in order:
        args = ["--raw", folder, "--lake", daily, "--start", str(day)]
        run(spark, parse_args(args))
    silver = [table(read_layer(spark, f"{lake}/silver")) for lake in (whole, daily)]
    assert silver[0] == silver[1]
    gold = [{n: table(t) for n, t in jobs.read_gold(spark, lake).items()} for lake in (whole, daily)]
    assert gold[0] == gold[1] and gold[0]["top_actors"] == [("ann", 6), ("bob", 2)]


def test_gold_does_not_depend_on_the_entry_point(spark, folder):
    for name, lines in TWO_DAYS.items():
        write_hour(folder, name, lines)
    lake = f"{folder}/lake"
    run(spark, parse_args(["--raw", folder, "--lake", lake, "--start", "2024-01-01"]))
    run(spark, parse_args(["--raw", folder, "--lake", lake, "--start", "2024-01-02"]))
    by_command = table(jobs.read_gold(spark, lake)["top_actors"])
    jobs.run_all(spark, [raw_glob(folder, D2, D2)], lake, D2, D2)
    assert table(jobs.read_gold(spark, lake)["top_actors"]) == by_command == [("ann", 6), ("bob", 2)]


def test_a_day_that_became_empty_is_removed(spark, folder):
    for name, lines in TWO_DAYS.items():
        write_hour(folder, name, lines)
    lake = f"{folder}/lake"
    jobs.run_all(spark, [f"{folder}/*.json.gz"], lake)
    write_hour(folder, "2024-01-02-5.json.gz", [])
    jobs.run_all(spark, [raw_glob(folder, D2, D2)], lake, D2, D2)
    assert read_layer(spark, f"{lake}/bronze", D2, D2).count() == 0
    assert table(jobs.read_gold(spark, lake)["top_actors"]) == [("ann", 6)]


def test_undated_events_and_broken_lines_alone(spark, folder):
    write_hour(folder, "2024-01-01-5.json.gz", [event("1", at="junk")])
    assert jobs.run_all(spark, [f"{folder}/*.json.gz"], f"{folder}/u")["top10_actors"].count() == 1
    write_hour(folder, "2024-01-01-5.json.gz", ["{broken"])
    assert jobs.run_all(spark, [f"{folder}/*.json.gz"], f"{folder}/x")["top10_actors"].count() == 0


def test_a_leaking_gate_fails_the_job(spark, folder, monkeypatch):
    write_hour(folder, "2024-01-01-5.json.gz", [event("1", type="IssuesEvent", payload={"labels": [label("x")]}), pull("2", label("y"))])
    lake = f"{folder}/lake"
    jobs.run_bronze(spark, [f"{folder}/*.json.gz"], lake)
    real = jobs.S.silver_marked
    leak = F.when(F.col("event_id") == "1", "x").otherwise(F.col("pr_label_name"))
    monkeypatch.setattr(jobs.S, "silver_marked", lambda b: real(b).withColumn("pr_label_name", leak))
    with pytest.raises(CheckFailed, match="leaked"):
        jobs.run_silver(spark, lake)


def test_every_row_of_a_report_is_printed(spark, folder, capsys):
    write_hour(folder, "2024-01-01-5.json.gz", [event("1")])
    write_hour(folder, "2024-01-02-5.json.gz", [event("2")])
    run(spark, parse_args(["--raw", folder, "--lake", "x", "--start", "2024-01-01", "--end", "2024-01-02", "--steps", "missing"]))
    assert capsys.readouterr().out.count(".json.gz") == 46


def test_a_lost_row_fails_the_job(spark, raw, folder, monkeypatch):
    real = jobs.write_by_date
    monkeypatch.setattr(jobs, "write_by_date", lambda df, *a, **k: real(df.filter("id <> 'd'"), *a, **k))
    with pytest.raises(CheckFailed):
        jobs.run_bronze(spark, [f"{raw}/*.json.gz"], f"{folder}/lake")


@pytest.mark.parametrize("change, message", [
    (lambda df: df.withColumn("event_date", F.when(F.col("id") == "t", F.lit(D1)).otherwise(F.col("event_date"))), "on 2024-01-0"),
    (lambda df: df.withColumn("event_date", F.when(F.col("id") == "junk", F.lit(D1)).otherwise(F.col("event_date"))), "on no date"),
    (lambda df: df.withColumn("public", ~F.col("public")), "other values"),
    (lambda df: df.withColumn("payload", F.when(F.col("id") != "p1", F.col("payload"))), "other values"),
    (lambda df: df.withColumn("org", F.lit(None).cast(df.schema["org"].dataType)).withColumn(
        "actor", F.col("actor").withField("login", F.col("actor.url")).withField("url", F.col("actor.login"))), "other values"),
    (lambda df: df.filter("id <> 'd'").unionByName(df.filter("id = 's0'")).unionByName(df.filter("id = 's1'")), "other values"),
])
def test_a_change_on_the_way_to_disk_fails_the_job(spark, raw, folder, monkeypatch, change, message):
    real = jobs.write_by_date
    monkeypatch.setattr(jobs, "write_by_date", lambda df, *a, **k: real(change(df), *a, **k))
    with pytest.raises(CheckFailed, match=message):
        jobs.run_bronze(spark, [f"{raw}/*.json.gz"], f"{folder}/lake")


def test_a_label_that_changes_on_the_way_fails_silver(spark, raw, folder, monkeypatch):
    lake = f"{folder}/lake"
    jobs.run_bronze(spark, [f"{raw}/*.json.gz"], lake)
    real = jobs.write_by_date
    other = F.when(F.col("pr_label_name") == "y", "z").otherwise(F.col("pr_label_name"))
    monkeypatch.setattr(jobs, "write_by_date", lambda df, *a, **k: real(df.withColumn("pr_label_name", other), *a, **k))
    with pytest.raises(CheckFailed, match="other values"):
        jobs.run_silver(spark, lake)


def test_content_is_free_of_order_and_counts_repeats(spark):
    rows = spark.createDataFrame([(1, D1), (2, D2), (2, D2), (3, None)], "n int, event_date date")
    found = Q.content(rows)
    assert found == Q.content(rows.orderBy("n", ascending=False).repartition(3))
    assert found.by_date == {"2024-01-01": 1, "2024-01-02": 2, "": 1} and found.rows == 4
    assert found.digest != Q.content(rows.distinct()).digest
    assert Q.content(rows.limit(0)) == Q.Content(0, 0, {})


def test_lost_events_fail_silver(spark, raw, folder, monkeypatch):
    lake = f"{folder}/lake"
    jobs.run_bronze(spark, [f"{raw}/*.json.gz"], lake)
    real = jobs.write_by_date
    monkeypatch.setattr(jobs, "write_by_date", lambda df, *a, **k: real(df.filter("event_id <> 'd'"), *a, **k))
    with pytest.raises(CheckFailed):
        jobs.run_silver(spark, lake)


def test_shared_input_is_released(spark):
    df = spark.range(10)
    with pytest.raises(ZeroDivisionError):
        with shared(df) as kept:
            assert kept.count() == 10 and kept.is_cached
            1 / 0
    assert not df.is_cached


def test_profile_of_raw_files(spark, raw):
    reports = jobs.profile(read_raw(spark, f"{raw}/*.json.gz"))
    assert all(report.collect() is not None for report in reports.values())
    assert reports["total_events"].first().total_events == 13


def test_command_line(spark, raw, folder, capsys):
    lake = f"{folder}/lake"
    every = ["missing", "bronze", "layout", "profile", "silver", "gold", "findings"]
    run(spark, parse_args(["--raw", raw, "--lake", lake, "--start", "2024-01-01", "--steps", *every]))
    out = capsys.readouterr().out
    assert "non_bot_of_top" in out and "2024-01-01-23.json.gz" in out
    for bad in (["--lake", "x"], ["--raw", "r", "--lake", "x", "--start", "2024-01-02", "--end", "2024-01-01"]):
        with pytest.raises(SystemExit):
            parse_args(bad)


def test_new_files_are_added_once(spark, raw, folder):
    target, checkpoint = f"{folder}/stream", f"{folder}/progress"
    for _ in range(2):
        ingest_new_files(spark, raw, target, checkpoint)
        assert spark.read.parquet(f"{target}/bronze").count() == 12
        assert spark.read.parquet(f"{target}/quarantine").count() == 1
    write_hour(raw, "2024-01-02-1.json.gz", [event("late", at="2024-01-02T01:00:00Z")])
    ingest_new_files(spark, raw, target, checkpoint)
    stored = read_layer(spark, f"{target}/bronze", D2, D2)
    assert sorted(r.id for r in stored.collect()) == ["late", "t"]
    assert jobs.run_silver(spark, target)["distinct_events"] == 12


def test_a_batch_that_is_stored_again_leaves_nothing_twice(spark, raw, folder):
    rows = read_raw(spark, f"{raw}/*.json.gz").withColumn("source_file", F.lit("f"))
    for _ in range(2):
        store_batch(f"{folder}/t")(rows, 7)
    store_batch(f"{folder}/t")(rows.limit(0), 8)
    assert spark.read.parquet(f"{folder}/t/bronze").count() == 12
    assert spark.read.parquet(f"{folder}/t/quarantine").count() == 1
