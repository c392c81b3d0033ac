from __future__ import annotations

from builders import bronze_rows, event, label, plan, pull, raw_rows
from pyspark.sql import functions as F

from eventlake.operators import gold as G
from eventlake.operators import quality as Q
from eventlake.operators import silver as S
from eventlake.operators.keep import one_row_per
from eventlake.schema import EVENT_SCHEMA, LABEL_SCHEMA, SILVER_COLUMNS
from eventlake.sources.layers import read_layer, write_by_date


def labelled(df):
    return sorted(
        ((r.event_id, r.pr_label_name, r.pr_label_color) for r in df.collect()),
        key=repr,
    )


def test_columns_and_types(spark):
    df = S.silver(bronze_rows(spark, [event()]))
    assert tuple(df.columns) == SILVER_COLUMNS
    assert dict(df.dtypes)["created_at"] == "timestamp_ntz"
    assert dict(df.dtypes)["event_date"] == "date"


def test_no_event_is_lost(spark):
    rows = [event("1"), pull("2"), pull("3", label("x"), label("y")),
            event("4", type="PullRequestEvent", payload={}), event("5", type=None)]
    df = S.silver(bronze_rows(spark, rows))
    assert labelled(df) == [
        ("1", None, None), ("2", None, None), ("3", "x", "f"), ("3", "y", "f"),
        ("4", None, None), ("5", None, None),
    ]


def test_inner_explode_drops_unlabelled(spark):
    gated = S.gate_labels(bronze_rows(spark, [event("1"), pull("2"), pull("3", label("x"))]))
    assert labelled(S.labels_inner(gated)) == [("3", "x", "f")]


def test_lowest_colour_survives(spark):
    rows = [pull("1", label("x", "f"), label("x", "e"), label("y", "d"), label("x", None))]
    assert labelled(S.silver(bronze_rows(spark, rows))) == [("1", "x", "e"), ("1", "y", "d")]


def test_issue_labels_do_not_leak(spark):
    issue = event("1", type="IssuesEvent", payload={"labels": [label("x")]})
    df = S.silver(bronze_rows(spark, [issue, pull("2", label("x"))]))
    assert labelled(df) == [("1", None, None), ("2", "x", "f")]
    assert [tuple(r) for r in Q.label_types(df).collect()] == [("PullRequestEvent", 1)]


def test_day_without_org_or_labels(spark):
    df = S.silver(bronze_rows(spark, [event("1"), event("2")]))
    assert {(r.org_login, r.pr_label_name) for r in df.collect()} == {(None, None)}


def test_redelivered_event_is_one_event(spark):
    twice = [event("1"), event("1"), pull("2", label("x")), pull("2", label("x"))]
    b = bronze_rows(spark, twice)
    assert labelled(S.silver(b)) == [("1", None, None), ("2", "x", "f")]
    assert S.events(b).count() == 2


def test_null_ids_are_one_event(spark):
    b = bronze_rows(spark, [event(None), event(None), event("1")])
    assert S.silver(b).count() == 2
    assert S.events(b).count() == 2


def test_copies_differing_in_content_keep_one_whole_row(spark):
    a, b = event("1", login="ann", repo="o/z"), event("1", login="bob", repo="o/a")
    for rows in ([a, b], [b, a]):
        got = S.events(bronze_rows(spark, rows), "actor_login", "repo_name").collect()
        assert [tuple(r) for r in got] == [("1", "ann", "o/z")]


def test_pull_request_copies_with_and_without_labels(spark):
    rows = [pull("1", label("x")), pull("1")]
    assert labelled(S.silver(bronze_rows(spark, rows))) == [("1", "x", "f"), ("1", None, None)]


def test_an_event_belongs_to_its_earliest_date(spark):
    late = {"at": "2024-01-02T00:00:00Z"}
    rows = [event("1", login="a", **late), event("1", login="z"), event("u", at="junk"), event("u", **late)]
    rows += [pull("p", label("new"), **late), pull("p", label("old")), pull("p", label("more"))]
    got = S.silver_marked(bronze_rows(spark, rows)).collect()
    assert sorted((r.event_id, str(r.event_date), r.actor_login, r.pr_label_name) for r in got) == [
        ("1", "2024-01-01", "z", None), ("p", "2024-01-01", "ann", "more"), ("p", "2024-01-01", "ann", "old"),
        ("u", "2024-01-02", "ann", None),
    ]
    assert sorted(r.event_id for r in got if r.opens_event) == ["1", "p", "u"]


def test_one_event_holding_a_third_of_all_rows(spark):
    n = 30_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, n, 1, 8).select(hot.alias("event_id"), F.lit("u").alias("actor_login"))
    kept = one_row_per(df, ["event_id"])
    assert kept.count() == n - n // 3 + 1
    text = plan(kept)
    assert "partial_min" in text and text.index("Exchange") < text.index("partial_min")


def test_event_grain_of_stored_silver(spark, folder):
    rows = [event("1"), event("1"), pull("2", label("x"), label("y")), pull("3"), event("4", type=None)]
    b = bronze_rows(spark, rows)
    write_by_date(S.silver(b), f"{folder}/silver", gather=True)
    stored = read_layer(spark, f"{folder}/silver")
    grain = S.event_grain(stored)
    assert sorted(map(tuple, grain.collect()), key=repr) == sorted(map(tuple, S.events(b).collect()), key=repr)


def test_one_pull_request_counts_once(spark):
    rows = [pull("1", *(label(f"l{i}") for i in range(5)), login="ann"), event("2", login="bob")]
    silver = S.silver(bronze_rows(spark, rows))
    assert silver.count() == 6
    got = G.top_actors(S.event_grain(silver, "actor_login")).collect()
    assert [tuple(r) for r in got] == [("ann", 1), ("bob", 1)]


def test_filter_by_type_may_go_before_event_grain(spark):
    rows = [event("1", type="WatchEvent"), event("1", type="WatchEvent"), pull("2", label("a"), label("b"))]
    b = bronze_rows(spark, rows)
    star = F.col("type") == "WatchEvent"
    assert S.events(b.filter(star)).collect() == S.events(b).filter(star).collect()
    s = S.silver(b)
    assert S.event_grain(s.filter(star)).collect() == S.event_grain(s).filter(star).collect()


def test_payload_is_read_for_pull_requests_only(spark, folder):
    write_by_date(bronze_rows(spark, [event("1"), pull("2", label("x"))]), f"{folder}/bronze")
    text = plan(S.silver(read_layer(spark, f"{folder}/bronze")))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    for scan in scans:
        pulls_only = "PushedFilters: [EqualNullSafe(type,PullRequestEvent)" in scan
        assert ("payload" in scan) == pulls_only
        assert "avatar_url" not in scan


def test_gold_scans_only_what_it_needs(spark, folder):
    write_by_date(S.silver(bronze_rows(spark, [event("1"), pull("2", label("x"))])), f"{folder}/s")
    stored = read_layer(spark, f"{folder}/s")
    starred = stored.filter(F.col("type") == "WatchEvent")
    text = plan(G.top_repos_by_stars(S.event_grain(starred, "type", "repo_name")))
    # The pull request path contradicts the filter and is gone, and with it the dedupe.
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "EqualTo(type,WatchEvent)" in text
    assert "ReadSchema: struct<type:string,repo_name:string>" in text
    text = plan(G.top_actors(S.event_grain(stored, "actor_login")))
    assert "ReadSchema: struct<type:string,actor_login:string>" in text
    assert "ReadSchema: struct<event_id:string,type:string,actor_login:string>" in text


def test_silver_scans_bronze_twice(spark, folder):
    write_by_date(bronze_rows(spark, [event("1"), event("1"), pull("2", label("x"))]), f"{folder}/b")
    text = plan(S.silver_marked(read_layer(spark, f"{folder}/b")))
    assert text.count("FileScan") == 2
    narrow, wide = sorted(text.split("FileScan")[1:], key=lambda t: "payload" in t.split("ReadSchema")[1][:900])
    assert "payload" not in narrow.split("ReadSchema")[1].split(">", 40)[0]


def test_reconciliation(spark):
    rows = [event("1"), pull("2", label("x"), label("y")), pull("3"), event(None)]
    s = S.silver(bronze_rows(spark, rows))
    assert Q.silver_reconcile(s).first().asDict() == {
        "rows": 5, "distinct_events": 4, "rows_with_label": 2, "surplus_rows": 1,
    }
    empty = S.silver(raw_rows(spark, []).drop("_corrupt_record").withColumn("event_date", F.lit(None).cast("date")))
    assert tuple(Q.silver_reconcile(empty).first()) == (0, 0, 0, 0)


def test_label_expectation(spark):
    rows = [pull("1", label("x"), label("x"), label("y")), pull("2"), pull("3", label("z"))]
    b = bronze_rows(spark, rows)
    got = Q.label_row_expectation(S.gate_labels(b), S.silver(b)).first()
    assert got.asDict() == {
        "events_with_labels": 2, "avg_labels": 2.0, "expected_rows": 4, "distinct_label_rows": 3, "actual_rows": 3,
    }


def test_label_expectation_of_redelivered_events_and_null_names(spark):
    rows = [pull("1", label("x"), label("y")), pull("1", label("x"), label("y")), pull("1", label("z"), label("x"))]
    rows += [pull("2", label(None)), event("3", type="IssuesEvent", payload={"labels": [label("no")]})]
    b = bronze_rows(spark, rows)
    got = Q.label_row_expectation(S.gate_labels(b), S.silver(b)).first()
    assert (got.distinct_label_rows, got.actual_rows) == (3, 3)
    leaking = S.silver(b).unionByName(S.silver(b).filter("event_id = '3'").withColumn("pr_label_name", F.lit("no")))
    got = Q.label_row_expectation(S.gate_labels(b), leaking).first()
    assert (got.distinct_label_rows, got.actual_rows) == (3, 4)


def test_two_tables_give_silver(spark, folder):
    rows = [
        event("1"), event("1"), pull("2", label("x"), label("y")), pull("3"), pull("4", label(None)),
        pull("5", label(None), label("z")), pull(None, label("n")),
        event("6", type="IssuesEvent", payload={"labels": [label("no")]}),
        pull("2", label("x"), at="2024-01-02T00:00:00Z"), event("7", type=None),
    ]
    marked = S.silver_marked(bronze_rows(spark, rows))
    write_by_date(S.event_table(marked), f"{folder}/events")
    write_by_date(S.label_table(marked), f"{folder}/labels")
    events = read_layer(spark, f"{folder}/events", schema=EVENT_SCHEMA)
    labels = read_layer(spark, f"{folder}/labels", schema=LABEL_SCHEMA)
    silver = S.silver(bronze_rows(spark, rows))
    view = S.silver_view(events, labels)
    key = lambda df: sorted((tuple(r[c] for c in silver.columns) for r in df.collect()), key=repr)
    assert key(view) == key(silver)
    assert events.count() == silver.select("event_id").distinct().count()
    assert "Exchange" not in plan(G.stars_per_repo(events).select("repo_name")).split("HashAggregate")[-1]
    assert "Exchange" not in plan(events.select("event_id", "actor_login"))
