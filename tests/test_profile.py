from __future__ import annotations

from builders import bronze_rows, event, label, plan, pull, raw_rows

from eventlake.operators import profile as P
from eventlake.operators import quality as Q
from eventlake.operators import silver as S
from eventlake.schema import BRONZE_SCHEMA, PAYLOAD_FIELDS
from eventlake.sources.layers import read_layer, write_by_date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def core(spark, events):
    return P.core_projection(raw_rows(spark, events))


def test_counts(spark):
    c = core(spark, [event("1"), event("1"), event("2", type="WatchEvent", org="o", public=False)])
    assert rows(P.total_events(c)) == [(3,)]
    assert rows(P.push_event_count(c)) == [(2,)]
    assert [tuple(r) for r in P.events_by_type(c).collect()] == [("PushEvent", 2), ("WatchEvent", 1)]
    assert rows(P.type_share(c)) == [("PushEvent", 2, 66.67), ("WatchEvent", 1, 33.33)]
    assert rows(P.public_counts(c)) == [(False, 1), (True, 2)]
    assert rows(P.org_null_ratio(c)) == [(3, 2, 0.6667)]
    assert rows(P.duplicate_ids(c)) == [(1,)]
    assert rows(P.created_at_range(c)) == [("2024-01-01T05:00:00Z",) * 2]


def test_null_counts_as_a_value(spark):
    c = core(spark, [event("1", login=None), event("2", login="a"), event("3", login="a", repo=None)])
    assert rows(P.cardinalities(c)) == [("actor_login", 2), ("repo_name", 2)]


def test_empty_input(spark):
    c = core(spark, [])
    assert rows(P.org_null_ratio(c)) == [(0, 0, None)]
    assert rows(P.type_share(c)) == []
    assert [r.total for r in P.payload_field_presence(raw_rows(spark, [])).collect()] == [0] * 8


def test_nested_select_names(spark):
    df = P.nested_select(raw_rows(spark, [event()]))
    assert df.columns == ["type", "login", "name", "created_at"]


def test_array_sizes(spark):
    events = [event("1"), pull("2"), pull("3", label("a"), label("b"), label("c"))]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        sizes = P.array_sizes(raw_rows(spark, events), ["labels"], "id")
        assert rows(sizes.select("id", "labels")) == [("1", None), ("2", 0), ("3", 3)]
    spark.conf.set("spark.sql.ansi.enabled", "true")
    got = P.array_size_stats(raw_rows(spark, events)).first()
    assert (got["count"], got["mean"], got["stddev"], got["min"], got["max"]) == (2, 1.5, 2.12132, 0, 3)


def test_array_profile_per_field_and_type(spark):
    wiki = event("9", type="GollumEvent", payload={"pages": [{"x": 1}, {"y": [2]}]})
    issue = event("8", type="IssuesEvent", payload={"labels": [label("x")], "assignees": [{"login": "a"}]})
    got = rows(P.array_field_profile(raw_rows(spark, [wiki, issue, pull("2", label("a")), event("1")])))
    assert got == [
        ("GollumEvent", "pages", 1, 2.0, 2), ("IssuesEvent", "assignees", 1, 1.0, 1),
        ("IssuesEvent", "labels", 1, 1.0, 1), ("PullRequestEvent", "labels", 1, 1.0, 1),
    ]


def test_reports_do_not_parse_the_payload(spark, folder):
    write_by_date(bronze_rows(spark, [event("1", payload={"ref": "a"}), pull("2", label("x"))]), f"{folder}/b")
    stored = read_layer(spark, f"{folder}/b", schema=BRONZE_SCHEMA)
    reports = [
        P.array_field_profile(stored), P.array_size_stats(stored), P.payload_field_presence(stored),
        P.payload_union_schema(stored), P.payload_keys_by_type(stored), Q.missing_payload_fields(stored),
    ]
    for df in reports:
        assert "payload:" in plan(df) and df.collect() is not None
    for df in [*reports, S.silver(stored)]:
        assert "from_json" not in plan(df) and "parseJson" not in plan(df)


def test_field_presence(spark):
    events = [
        event("1", payload={"ref": "a", "push_id": 1}),
        event("2", payload={"ref": None, "push_id": 2}),
        event("3", type="CreateEvent", payload={"ref": "x", "size": 3}),
    ]
    got = {r.field: (r.in_schema, r.non_null, r.total, r.non_null_ratio)
           for r in P.payload_field_presence(raw_rows(spark, events)).collect()}
    assert got["ref"] == (True, 1, 2, 0.5)
    assert got["push_id"] == (True, 2, 2, 1.0)
    assert got["size"] == (True, 0, 2, 0.0)
    assert got["commits"] == (False, 0, 2, 0.0)


def test_missing_fields(spark):
    raw = raw_rows(spark, [event("1", payload={"ref": "a", "novel": 1}), event("2", payload=None)])
    missing = [r.field for r in Q.missing_payload_fields(raw).collect()]
    assert missing == [f for f in PAYLOAD_FIELDS if f != "ref"]


def test_union_schema_merges_types(spark):
    raw = raw_rows(spark, [
        event("1", payload={"a": 1, "b": [{"n": "x"}]}),
        event("2", payload={"a": 2, "b": [{"m": True}]}),
        event("3", payload=None),
    ])
    got = {r.field: (r.field_type, r.event_count) for r in P.payload_union_schema(raw).collect()}
    assert got == {"a": ("BIGINT", 2), "b": ("ARRAY<OBJECT<m: BOOLEAN, n: STRING>>", 2)}


def test_keys_by_type(spark):
    raw = raw_rows(spark, [event("1", payload={"a": 1}), event("2", type="X", payload={"a": None}), event("3", payload={})])
    assert rows(P.payload_keys_by_type(raw)) == [("PushEvent", "a", 1), ("X", "a", 1)]


def test_core_leaves_the_payload_out(spark):
    assert "payload" not in P.core_projection(raw_rows(spark, [event()])).columns


def test_schema_changes(spark):
    def on(day, payload, i=[0]):  # noqa: B006
        i[0] += 1
        return event(str(i[0]), at=f"2024-01-{day:02d}T05:00:00Z", payload=payload)

    events = [
        on(1, {"a": 1, "b": "x", "gone": [1]}), on(1, {"a": 2}),
        on(3, {"a": 1, "b": None, "new": {"n": 1}}), on(3, {"a": "one"}),
        on(4, {"a": "two", "new": {}}), event("n", at="junk", payload={"never": 1}),
    ]
    kinds = P.payload_kinds_by_date(bronze_rows(spark, events))
    got = [(r.event_date.day, r.field, r.change, r.kinds_before, r.kinds) for r in P.schema_changes(kinds).collect()]
    assert sorted(got) == [
        (3, "a", "changed", "BIGINT", "BIGINT,STRING"), (3, "b", "lost", "STRING", None),
        (3, "gone", "lost", "ARRAY", None), (3, "new", "gained", None, "OBJECT"),
        (4, "a", "changed", "BIGINT,STRING", "STRING"),
    ]
    assert P.schema_changes(kinds.limit(0)).collect() == []
