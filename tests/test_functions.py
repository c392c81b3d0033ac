from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlake.functions.accounts import is_not_bot
from eventlake.functions.measures import percent, ratio, spread_percent
from eventlake.functions.payload import fields, keys, pr_labels
from eventlake.functions.timestamps import hour_of_day, parse_utc, parse_utc_date


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("x")).first().x


def test_wall_clock_in_any_zone(spark, any_zone):
    # 02:30 does not exist in New York on this day.
    text = "2026-03-08T02:30:00Z"
    assert one(spark, text, parse_utc("v")) == dt.datetime(2026, 3, 8, 2, 30)
    assert one(spark, text, hour_of_day(parse_utc("v"))) == 2
    assert one(spark, text, parse_utc_date("v")) == dt.date(2026, 3, 8)


@pytest.mark.parametrize(
    "text",
    [
        None, "", "junk", "2026-03-08", "2026-03-08T02:30:00", "2026-03-08 02:30:00Z",
        "2026-3-08T02:30:00Z", "2026-13-08T02:30:00Z", "2026-02-30T02:30:00Z",
        "2026-03-08T24:00:00Z", "2026-03-08T02:30:00+01:00", " 2026-03-08T02:30:00Z",
        "2026-03-08T02:30:00.5Z", "2026-03-08T02:30:00Z\n",
    ],
)
def test_anything_else_is_null(spark, text):
    assert one(spark, text, parse_utc("v")) is None
    assert one(spark, text, parse_utc_date("v")) is None


def test_labels_only_of_pull_requests(spark):
    payload = '{"labels":[{"name":"bug","color":"f00","default":true},{"name":null}]}'
    df = spark.createDataFrame(
        [("PullRequestEvent", payload), ("IssuesEvent", payload), (None, payload),
         ("PullRequestEvent", "{}"), ("PullRequestEvent", "junk"), ("PullRequestEvent", None)],
        "type string, payload string",
    ).withColumn("payload", F.try_parse_json("payload"))
    got = [r.x for r in df.select(pr_labels().alias("x")).collect()]
    assert [tuple(e) for e in got[0]] == [("bug", "f00"), (None, None)]
    assert got[1:] == [None] * 5


def test_fields_and_keys(spark):
    text = '{"a":1,"b":null,"c":{"d":[1, 2]}}'
    assert one(spark, text, keys(F.try_parse_json("v"))) == ["a", "b", "c"]
    got = one(spark, text, fields(["a", "b", "c", "z"], F.try_parse_json("v")))
    assert (got.a, got.b, got.z) == ("1", None, None) and '"d"' in got.c
    assert one(spark, "[1]", keys(F.try_parse_json("v"))) is None


def test_bots(spark):
    df = spark.createDataFrame([("a",), ("a[bot]",), (None,), ("[bot]a",)], "v string")
    assert [r.v for r in df.filter(is_not_bot("v")).collect()] == ["a", "[bot]a"]


def test_measures_survive_zero(spark):
    df = spark.range(1)
    got = df.select(
        ratio(F.lit(1), F.lit(3)).alias("r"), percent(F.lit(1), F.lit(3)).alias("p"),
        spread_percent(F.lit(460), F.lit(371)).alias("s"),
        ratio(F.lit(1), F.lit(0)).alias("z"), spread_percent(F.lit(1), F.lit(0)).alias("y"),
    ).first()
    assert tuple(got) == (0.3333, 33.33, 24.0, None, None)
