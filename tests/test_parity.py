"""Every query against DuckDB, in two session time zones."""

from __future__ import annotations

import os

import pytest
from parity import oracle_connection, oracle_rows, spark_rows

from __spark_entry__ import entry
from eventlake.plans.catalog import QUERIES
from eventlake.plans.oracle import ORACLE_SQL

SF = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
SF_MEDIUM = "/root/testdata/sf0.01"
# Results that only Spark can produce: file sizes, Spark's hash, variant type names.
ROWS_ONLY = {"partition_layout", "key_skew_report", "payload_union_schema"}


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


def test_every_query_has_an_oracle_or_a_reason():
    assert set(QUERIES) - set(ORACLE_SQL) == ROWS_ONLY
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, duck, any_zone, name):
    assert spark_rows(QUERIES[name](spark, SF)) == oracle_rows(duck, ORACLE_SQL[name])


@pytest.fixture()
def other_settings(spark):
    changed = {"spark.sql.ansi.enabled": "false", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name",
    ["array_field_profile", "array_sizes", "created_at_parsed", "label_gate",
     "label_row_expectation", "org_null_ratio", "silver", "silver_with_broken_lines"],
)
def test_does_not_depend_on_ansi_or_adaptive_execution(spark, duck, other_settings, name):
    assert spark_rows(QUERIES[name](spark, SF)) == oracle_rows(duck, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).first().asDict() == {"actor_login": "user14", "event_count": 85}


def test_published_sample_figures(spark):
    """Figures of FIXTURES.md section 3."""
    run = lambda n: QUERIES[n](spark, SF_MEDIUM)
    assert run("silver_exploded").count() == 11514
    assert run("silver").count() == 10992
    assert run("event_grain").count() == 10000
    assert [tuple(r) for r in run("top_actors").take(4)] == [
        ("ci-runner[bot]", 600), ("user149", 82), ("user47", 80), ("user89", 80),
    ]
    assert run("non_bot_of_top").count() == 18
    hours = run("hour_peak_quiet").first()
    assert (hours.peak_count, hours.quiet_count, hours.spread_pct) == (460, 371, 24.0)
    assert run("missing_hours").count() == 0


def test_key_skew_report_adds_up(spark):
    rows = QUERIES["key_skew_report"](spark, SF).collect()
    actors = {r.column_name: r.distinct_values for r in QUERIES["cardinalities"](spark, SF).collect()}
    assert sum(r.rows for r in rows) == 1000
    assert sum(r["keys"] for r in rows) == actors["actor_login"]
    assert max(r.largest_key_rows for r in rows) == QUERIES["heaviest_key"](spark, SF).first().event_count
