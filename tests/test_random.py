"""Random events with many copies, against a plain Python account of the rules."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from builders import bronze_rows, event, label

from eventlake.operators import gold as G
from eventlake.operators import profile as P
from eventlake.operators import quality as Q
from eventlake.operators import silver as S

TYPES = ["PullRequestEvent", "IssuesEvent", "PushEvent", "WatchEvent", None]


def random_events(seed: int, n: int = 3000) -> list[dict]:
    """Content depends on the id alone, except for labels, which copies may differ in."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        # A third of all rows are copies of one event.
        i = 3 if rng.random() < 1 / 3 else rng.randrange(900)
        own = random.Random(i)
        kind = own.choice(TYPES)
        payload = {"action": "opened"}
        if kind in ("PullRequestEvent", "IssuesEvent") and rng.random() < 0.8:
            payload["labels"] = [
                label(rng.choice(["a", "b", "c", None]), rng.choice(["1", "2", None]))
                for _ in range(rng.randrange(5))
            ]
        out.append(
            event(
                id=None if i == 7 else str(i),
                type=kind,
                login=own.choice(["ann", "bob", "x[bot]", None]),
                repo=own.choice(["r1", "r2", None]),
                at=own.choice(["2024-01-01T05:00:00Z", "2024-01-02T05:30:00Z", "2024-01-02T23:59:59Z", "junk"]),
                payload=payload,
            )
        )
    return out


def silver_rows(events: list[dict]) -> set[tuple]:
    colours: dict[tuple, list] = {}
    for e in events:
        labels = e["payload"].get("labels") if e["type"] == "PullRequestEvent" else None
        for lb in labels or [{"name": None, "color": None}]:
            key = (e["id"], e["type"], e["actor"]["login"], lb["name"])
            colours.setdefault(key, []).append(lb["color"])
    return {(*k, min((c for c in v if c is not None), default=None)) for k, v in colours.items()}


def one_each(events: list[dict]) -> list[dict]:
    return list({e["id"]: e for e in events}.values())


def hour(e: dict) -> int | None:
    return None if e["created_at"] == "junk" else int(e["created_at"][11:13])


@pytest.fixture(scope="module", params=[1, 2])
def made(request, spark):
    events = random_events(request.param)
    return events, bronze_rows(spark, events).repartition(8).cache()


def test_silver(made):
    events, bronze = made
    names = ["event_id", "type", "actor_login", "pr_label_name", "pr_label_color"]
    expected = silver_rows(events)
    plainly = [tuple(r) for r in S.silver(bronze).select(names).collect()]
    assert len(plainly) == len(expected) and set(plainly) == expected


def test_event_grain_and_summaries(made):
    events, bronze = made
    single = one_each(events)
    stored = S.silver(bronze)
    for grain in (S.events(bronze), S.event_grain(stored)):
        assert grain.count() == len(single)
        actors = Counter(e["actor"]["login"] for e in single)
        assert {tuple(r) for r in G.top_actors(grain).collect()} == set(actors.items())
        stars = Counter(e["repo"]["name"] for e in single if e["type"] == "WatchEvent")
        assert {tuple(r) for r in G.top_repos_by_stars(grain).collect()} == set(stars.items())
        hours = Counter(hour(e) for e in single)
        assert {tuple(r) for r in G.events_by_hour(grain).collect()} == set(hours.items())


def test_reports(made):
    events, bronze = made
    ids = Counter(e["id"] for e in events)
    core = P.core_projection(bronze)
    assert P.duplicate_ids(core).first().duplicate_ids == sum(n > 1 for n in ids.values())
    assert P.distinct_event_count(core).first().distinct_events == len(ids)
    rows = silver_rows(events)
    labelled = sum(r[3] is not None for r in rows)
    assert tuple(Q.silver_reconcile(S.silver(bronze)).first()) == (
        len(rows), len(ids), labelled, len(rows) - len(ids),
    )
    logins = {e["actor"]["login"] for e in events}
    assert P.cardinalities(core).first().distinct_values == len(logins)
