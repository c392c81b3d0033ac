"""Hand-made raw events."""

from __future__ import annotations

import gzip
import json
import os

from pyspark.sql import functions as F

from eventlake.operators.bronze import bronze
from eventlake.schema import RAW_SCHEMA


def event(id="1", type="PushEvent", login="ann", repo="o/r", at="2024-01-01T05:00:00Z", org=None, payload=None, **more):
    out = {
        "id": id,
        "type": type,
        "actor": {"id": 1, "login": login},
        "repo": {"id": 2, "name": repo},
        "public": True,
        "created_at": at,
        "payload": payload if payload is not None else {},
    }
    if org:
        out["org"] = {"id": 3, "login": org}
    out.update(more)
    return out


def label(name, color="f"):
    return {"name": name, "color": color, "url": "x"}


def pull(id, *labels, **more):
    return event(id=id, type="PullRequestEvent", payload={"action": "opened", "labels": list(labels)}, **more)


def raw_rows(spark, events):
    """Events as raw rows, through the same JSON parsing as files."""
    rows = []
    for e in events:
        rows.append(
            (
                e.get("id"),
                e.get("type"),
                _account(e.get("actor")),
                (e["repo"]["id"], e["repo"]["name"], None) if e.get("repo") else None,
                _account(e.get("org")),
                e.get("public"),
                e.get("created_at"),
                json.dumps(e["payload"]) if e.get("payload") is not None else None,
                None,
            )
        )
    text = spark.createDataFrame(rows, RAW_SCHEMA.replace("payload variant", "payload string"))
    return text.withColumn("payload", F.try_parse_json("payload"))


def _account(a):
    return (a["id"], a["login"], None, None, None, None) if a else None


def bronze_rows(spark, events):
    return bronze(raw_rows(spark, events))


def write_hour(folder, name, lines):
    """One raw file; a line is an event or broken text."""
    path = os.path.join(folder, name)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        for line in lines:
            f.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return path


def plan(df) -> str:
    """Physical plan text."""
    return df._jdf.queryExecution().executedPlan().toString()
