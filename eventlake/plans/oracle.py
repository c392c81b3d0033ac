"""The same results in SQL, written independently, for a second engine to run.

``raw`` derives the sample rows from the events table by the rules of FIXTURES.md;
``redelivered`` repeats every tenth event.
"""

from __future__ import annotations

_RAW = """
base AS (
  SELECT event_id, user_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    CASE event_type WHEN 'purchase' THEN 'PullRequestEvent'
      WHEN 'signup' THEN 'IssuesEvent' WHEN 'view' THEN 'PushEvent'
      WHEN 'click' THEN 'WatchEvent' WHEN 'error' THEN 'CreateEvent' END AS type
  FROM events),
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, type, k, event_id AS n,
    CASE WHEN k < 6 THEN 0 ELSE user_id END AS actor_id,
    CASE WHEN k < 6 THEN 'ci-runner[bot]'
      WHEN user_id % 10 = 0 THEN 'user' || user_id || '[bot]'
      ELSE 'user' || user_id END AS actor_login,
    k AS repo_id, 'org' || (k % 7) || '/repo' || k AS repo_name,
    CASE WHEN event_id % 25 = 0 THEN 'org' || (k % 7) END AS org_login,
    event_id % 1000 <> 0 AS public,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_text,
    date_trunc('second', ts) AS created_at,
    CAST(ts AS DATE) AS event_date,
    CAST(hour(ts) AS INTEGER) AS hour,
    type IN ('PullRequestEvent', 'IssuesEvent') AS thread,
    CASE WHEN NOT type IN ('PullRequestEvent', 'IssuesEvent') THEN NULL
      WHEN k % 4 > 0 THEN list_transform(range(1, k % 4 + 1),
        lambda i: {'name': 'l' || ((k + i) % 2), 'color': 'c' || ((k + i) % 2)})
      WHEN k % 8 = 0 THEN [] END AS labels,
    CASE WHEN type IN ('PullRequestEvent', 'IssuesEvent') AND k % 5 = 0
      THEN 1 + k % 2 END AS n_assignees
  FROM base),
fields AS (
  SELECT type, event_date, unnest([
    {'field': 'action', 'kind': 'STRING', 'hit': type = 'WatchEvent' OR thread},
    {'field': 'assignees', 'kind': 'ARRAY', 'hit': n_assignees IS NOT NULL},
    {'field': 'before', 'kind': 'STRING', 'hit': type = 'PushEvent'},
    {'field': 'head', 'kind': 'STRING', 'hit': type = 'PushEvent' AND k % 20 <> 0},
    {'field': 'labels', 'kind': 'ARRAY', 'hit': labels IS NOT NULL},
    {'field': 'master_branch', 'kind': 'STRING', 'hit': type = 'CreateEvent'},
    {'field': 'number', 'kind': 'BIGINT', 'hit': thread},
    {'field': 'push_id', 'kind': 'BIGINT', 'hit': type = 'PushEvent'},
    {'field': 'pusher_type', 'kind': 'STRING', 'hit': type = 'CreateEvent'},
    {'field': 'ref', 'kind': 'STRING', 'hit': type IN ('PushEvent', 'CreateEvent')},
    {'field': 'ref_type', 'kind': 'STRING', 'hit': type = 'CreateEvent'},
    {'field': 'repository_id', 'kind': 'BIGINT', 'hit': type = 'PushEvent'}],
    recursive := true)
  FROM raw),
redelivered AS (
  SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE n % 10 = 0)
"""

_FLAT = (
    "event_id, type, actor_id, actor_login, repo_id, repo_name, org_login, public, "
    "created_at, event_date"
)


def _exploded(source: str) -> str:
    return f"""SELECT {_FLAT}, lb.name AS pr_label_name, lb.color AS pr_label_color
      FROM (SELECT *, CASE WHEN type = 'PullRequestEvent' THEN labels END AS pr
            FROM {source}) s
      LEFT JOIN LATERAL (SELECT unnest(pr) AS lb) ON true"""


_SILVER = f"""
silver AS (
  SELECT {_FLAT}, pr_label_name, min(pr_label_color) AS pr_label_color
  FROM ({_exploded("redelivered")})
  GROUP BY ALL),
stars AS (
  SELECT repo_name, count(*) AS star_count FROM raw WHERE type = 'WatchEvent'
  GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20),
hours AS (SELECT hour, count(*) AS event_count FROM raw GROUP BY 1),
actors AS (
  SELECT actor_login, count(*) AS event_count FROM raw
  GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20)
"""

_WITH = f"WITH {_RAW}, {_SILVER} "

_RECONCILE = """SELECT CAST(count(*) AS BIGINT) AS rows,
    count(DISTINCT event_id) AS distinct_events, count(pr_label_name) AS rows_with_label,
    CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS surplus_rows FROM silver"""

# Payload field names.
_PUSH_FIELDS = (
    "'push_id', 'ref', 'commits', 'size', 'distinct_size', 'before', 'head', "
    "'repository_id'"
)
_ALL_FIELDS = (
    "'action', 'assignee', 'assignees', 'before', 'comment', 'description', "
    "'discussion', 'forkee', 'full_ref', 'head', 'issue', 'label', 'labels', "
    "'master_branch', 'member', 'number', 'pages', 'pull_request', 'push_id', "
    "'pusher_type', 'ref', 'ref_type', 'release', 'repository_id', 'review'"
)

_BODIES: dict[str, str] = {
    "raw_events": f"SELECT {_FLAT} FROM raw",
    "bronze_roundtrip": """SELECT event_date, count(*) AS written, count(*) AS read_back
        FROM raw GROUP BY 1""",
    "gold_roundtrip": """
        SELECT 'top_repos_by_stars' AS table_name, count(*) AS rows,
          CAST(sum(star_count) AS BIGINT) AS total FROM stars
        UNION ALL SELECT 'events_by_hour', count(*), CAST(sum(event_count) AS BIGINT) FROM hours
        UNION ALL SELECT 'top_actors', count(*), CAST(sum(event_count) AS BIGINT) FROM actors""",
    "layout_check": """SELECT event_date, true AS has_files, true AS has_data,
        count(*) AS rows FROM raw GROUP BY 1""",
    "missing_files": """
        SELECT CAST(t AS DATE) AS event_date, CAST(hour(t) AS INTEGER) AS hour
        FROM (SELECT unnest(generate_series(
                CAST((SELECT min(event_date) FROM raw) AS TIMESTAMP),
                CAST((SELECT max(event_date) FROM raw) AS TIMESTAMP) + INTERVAL 71 HOUR,
                INTERVAL 1 HOUR)) AS t)
        WHERE t NOT IN (SELECT date_trunc('hour', created_at) FROM raw)""",
    "short_hours": """
        SELECT event_date, hour, lines, usual FROM (
          SELECT event_date, hour, lines, median(lines) OVER (
            ORDER BY date_diff('day', DATE '1970-01-01', event_date) * 24 + hour
            RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS usual
          FROM (SELECT event_date, hour, count(*) AS lines FROM raw
            WHERE (day(event_date) * 24 + hour) % 29 <> 3 OR n % 4 = 0 GROUP BY 1, 2))
        WHERE lines < 0.5 * usual""",
    "missing_hours_by_actor": """
        SELECT actor_login, CAST(t AS DATE) AS event_date, CAST(hour(t) AS INTEGER) AS hour
        FROM (SELECT actor_login, unnest(generate_series(
                CAST(min(event_date) AS TIMESTAMP),
                CAST(max(event_date) AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS t
              FROM raw GROUP BY 1)
        WHERE (actor_login, t) NOT IN
          (SELECT (actor_login, date_trunc('hour', created_at)) FROM raw)""",
    "events_on_date": """SELECT event_id, type, event_date FROM raw
        WHERE event_date = (SELECT max(event_date) FROM raw)""",
    "top_level_fields": """
        SELECT field, count(*) AS event_count FROM (
          SELECT unnest(['id', 'type', 'actor', 'repo', 'public', 'created_at', 'payload'])
            AS field FROM raw
          UNION ALL SELECT 'org' FROM raw WHERE org_login IS NOT NULL) GROUP BY 1""",
    "unknown_fields": """SELECT event_id,
        '{"event":{"novel":' || event_id || '},"actor":{"plan":"p"}}' AS rest
        FROM raw WHERE n % 50 = 0""",
    "record_union_kinds": """
        SELECT field, kind, count(*) AS event_count FROM (
          SELECT unnest([
            {'field': 'id', 'kind': 'STRING', 'org': false}, {'field': 'type', 'kind': 'STRING', 'org': false},
            {'field': 'actor', 'kind': 'OBJECT', 'org': false}, {'field': 'repo', 'kind': 'OBJECT', 'org': false},
            {'field': 'org', 'kind': 'OBJECT', 'org': true}, {'field': 'public', 'kind': 'BOOLEAN', 'org': false},
            {'field': 'created_at', 'kind': 'STRING', 'org': false}, {'field': 'payload', 'kind': 'OBJECT', 'org': false},
            {'field': 'actor.id', 'kind': 'BIGINT', 'org': false}, {'field': 'actor.login', 'kind': 'STRING', 'org': false},
            {'field': 'actor.display_login', 'kind': 'STRING', 'org': false}, {'field': 'actor.avatar_url', 'kind': 'STRING', 'org': false},
            {'field': 'actor.gravatar_id', 'kind': 'STRING', 'org': false}, {'field': 'actor.url', 'kind': 'STRING', 'org': false},
            {'field': 'repo.id', 'kind': 'BIGINT', 'org': false}, {'field': 'repo.name', 'kind': 'STRING', 'org': false},
            {'field': 'repo.url', 'kind': 'STRING', 'org': false},
            {'field': 'org.id', 'kind': 'BIGINT', 'org': true}, {'field': 'org.login', 'kind': 'STRING', 'org': true},
            {'field': 'org.display_login', 'kind': 'STRING', 'org': true}, {'field': 'org.avatar_url', 'kind': 'STRING', 'org': true},
            {'field': 'org.gravatar_id', 'kind': 'STRING', 'org': true}, {'field': 'org.url', 'kind': 'STRING', 'org': true}],
            recursive := true), org_login FROM raw)
        WHERE NOT org OR org_login IS NOT NULL GROUP BY 1, 2""",
    "corrupt_count": """SELECT count(*) AS lines,
        count(*) FILTER (n % 100 = 7) AS broken_lines,
        count(*) FILTER (n % 100 <> 7) AS events FROM raw""",
    "missing_hours": """
        SELECT CAST(t AS DATE) AS event_date, CAST(hour(t) AS INTEGER) AS hour
        FROM (SELECT unnest(generate_series(
                CAST((SELECT min(event_date) FROM raw) AS TIMESTAMP),
                CAST((SELECT max(event_date) FROM raw) AS TIMESTAMP) + INTERVAL 23 HOUR,
                INTERVAL 1 HOUR)) AS t)
        WHERE t NOT IN (SELECT date_trunc('hour', created_at) FROM raw)""",
    "nested_select": """SELECT type, actor_login AS login, repo_name AS name,
        created_text AS created_at FROM raw""",
    "core_projection": """SELECT event_id, type, actor_login, actor_id, repo_name, repo_id,
        public, created_text AS created_at, org_login FROM raw""",
    "created_at_parsed": "SELECT event_id, created_at, event_date, hour FROM raw",
    "array_sizes": """SELECT event_id, type, CAST(len(labels) AS INTEGER) AS n_labels
        FROM raw""",
    "silver_flat": f"SELECT {_FLAT} FROM raw",
    "label_gate": """SELECT type,
        CAST(coalesce(sum(len(labels)), 0) AS BIGINT) AS labels_in_payload,
        CAST(coalesce(sum(CASE WHEN type = 'PullRequestEvent' THEN len(labels) END), 0)
          AS BIGINT) AS labels_kept
        FROM raw GROUP BY 1""",
    "silver_exploded": _exploded("raw"),
    "labels_inner": """SELECT event_id, lb.name AS pr_label_name, lb.color AS pr_label_color
        FROM (SELECT event_id, unnest(labels) AS lb FROM raw WHERE type = 'PullRequestEvent')""",
    "silver": "SELECT * FROM silver",
    "event_grain": f"SELECT DISTINCT {_FLAT} FROM silver",
    "event_rows": f"SELECT DISTINCT {_FLAT} FROM redelivered",
    "rows_with_label": """SELECT count(*) AS rows_with_label FROM silver
        WHERE pr_label_name IS NOT NULL""",
    "label_types": """SELECT type, count(*) AS event_count FROM silver
        WHERE pr_label_name IS NOT NULL GROUP BY 1""",
    "label_sample": """SELECT event_id, repo_name, pr_label_name, pr_label_color
        FROM silver WHERE pr_label_name IS NOT NULL
        ORDER BY event_id, pr_label_name LIMIT 10""",
    "silver_reconcile": _RECONCILE,
    "silver_with_broken_lines": f"{_RECONCILE} WHERE CAST(event_id AS BIGINT) % 100 <> 7",
    "label_row_expectation": """SELECT count(*) AS events_with_labels,
        round(avg(len(labels)), 4) AS avg_labels,
        CAST(sum(len(labels)) AS BIGINT) AS expected_rows,
        (SELECT count(*) FROM (SELECT DISTINCT event_id, unnest(labels).name FROM redelivered
           WHERE type = 'PullRequestEvent')) AS distinct_label_rows,
        (SELECT count(*) FROM silver WHERE pr_label_name IS NOT NULL) AS actual_rows
        FROM redelivered WHERE type = 'PullRequestEvent' AND len(labels) > 0""",
    "silver_by_day": "SELECT * FROM silver",
    "silver_view": "SELECT * FROM silver",
    "event_table": f"SELECT DISTINCT {_FLAT} FROM silver",
    "gold_by_day": """
        SELECT 'top_repos_by_stars' AS table_name, repo_name AS key, star_count AS n FROM stars
        UNION ALL SELECT 'events_by_hour', CAST(hour AS VARCHAR), event_count FROM hours
        UNION ALL SELECT 'top_actors', actor_login, event_count FROM actors""",
    "stream_unique_events": f"SELECT DISTINCT {_FLAT} FROM redelivered",
    "stream_hours": """SELECT event_date, hour, count(*) AS event_count
        FROM raw GROUP BY 1, 2""",
    "top_repos_by_stars": "SELECT * FROM stars",
    "events_by_hour": "SELECT * FROM hours ORDER BY hour",
    "events_by_date_and_hour": """SELECT event_date, hour, count(*) AS event_count
        FROM raw GROUP BY 1, 2""",
    "top_actors": "SELECT * FROM actors",
    "top_repos_by_events": """SELECT repo_name, count(*) AS event_count FROM raw
        GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10""",
    "hour_peak_quiet": """
        SELECT (SELECT hour FROM hours ORDER BY event_count DESC, hour LIMIT 1) AS peak_hour,
          max(event_count) AS peak_count,
          (SELECT hour FROM hours ORDER BY event_count, hour LIMIT 1) AS quiet_hour,
          min(event_count) AS quiet_count, CAST(sum(event_count) AS BIGINT) AS total_events,
          round((CAST(max(event_count) AS DOUBLE) / min(event_count) - 1) * 100, 1) AS spread_pct
        FROM hours""",
    "top10_repos": "SELECT * FROM stars ORDER BY star_count DESC, repo_name LIMIT 10",
    "top10_actors": "SELECT * FROM actors ORDER BY event_count DESC, actor_login LIMIT 10",
    "non_bot_of_top": "SELECT * FROM actors WHERE NOT ends_with(actor_login, '[bot]')",
    "top_non_bot_actors": """SELECT actor_login, count(*) AS event_count FROM raw
        WHERE NOT ends_with(actor_login, '[bot]')
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "total_events": "SELECT count(*) AS total_events FROM raw",
    "events_by_type": "SELECT type, count(*) AS event_count FROM raw GROUP BY 1",
    "push_event_count": """SELECT count(*) AS push_events FROM raw
        WHERE type = 'PushEvent'""",
    "type_share": """SELECT type, count(*) AS event_count,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share_pct
        FROM raw GROUP BY 1""",
    "actor_share": """SELECT actor_login, count(*) AS event_count,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share_pct
        FROM raw GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20""",
    "duplicate_ids": """SELECT count(*) AS duplicate_ids FROM
        (SELECT event_id FROM redelivered GROUP BY 1 HAVING count(*) > 1)""",
    "distinct_event_count": """SELECT count(DISTINCT event_id) AS distinct_events
        FROM redelivered""",
    "actor_group_count": """SELECT count(*) AS groups
        FROM (SELECT actor_login FROM raw GROUP BY 1)""",
    "created_at_range": """SELECT min(created_text) AS min_ts, max(created_text) AS max_ts
        FROM raw""",
    "public_counts": "SELECT public, count(*) AS event_count FROM raw GROUP BY 1",
    "org_null_ratio": """SELECT count(*) AS total_events,
        count(*) - count(org_login) AS org_null,
        round(CAST(count(*) - count(org_login) AS DOUBLE) / count(*), 4) AS org_null_ratio
        FROM raw""",
    "cardinalities": """
        SELECT 'actor_login' AS column_name, count(*) AS distinct_values
          FROM (SELECT DISTINCT actor_login FROM raw)
        UNION ALL SELECT 'repo_name', count(*) FROM (SELECT DISTINCT repo_name FROM raw)""",
    "schema_changes": """
        SELECT * FROM (WITH kinds AS (
          SELECT event_date, field, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM (
            SELECT event_date, field, kind FROM fields WHERE hit
            UNION ALL SELECT event_date, 'novel', CASE WHEN day(event_date) % 9 = 0 THEN 'STRING' ELSE 'BIGINT' END
            FROM raw WHERE day(event_date) % 3 = 0) GROUP BY 1, 2),
        dates AS (SELECT event_date, lead(event_date) OVER (ORDER BY event_date) AS after
          FROM (SELECT DISTINCT event_date FROM kinds)),
        before AS (SELECT after AS event_date, field, kinds AS kinds_before
          FROM kinds JOIN dates USING (event_date) WHERE after IS NOT NULL)
        SELECT event_date, field, CASE WHEN kinds_before IS NULL THEN 'gained' WHEN kinds IS NULL THEN 'lost'
          ELSE 'changed' END AS change, kinds_before, kinds
        FROM kinds FULL JOIN before USING (event_date, field)
        WHERE event_date > (SELECT min(event_date) FROM kinds) AND kinds IS DISTINCT FROM kinds_before)""",
    "payload_keys_by_type": """SELECT type, field, count(*) AS event_count FROM fields
        WHERE hit GROUP BY 1, 2""",
    "payload_field_kinds": """SELECT field, kind, count(*) AS event_count FROM fields
        WHERE hit GROUP BY 1, 2""",
    "payload_field_presence": f"""
        SELECT c.field, coalesce(bool_or(f.hit), false) AS in_schema,
          count(*) FILTER (f.hit AND f.type = 'PushEvent') AS non_null,
          (SELECT count(*) FROM raw WHERE type = 'PushEvent') AS total,
          round(CAST(count(*) FILTER (f.hit AND f.type = 'PushEvent') AS DOUBLE)
            / (SELECT count(*) FROM raw WHERE type = 'PushEvent'), 4) AS non_null_ratio
        FROM (SELECT unnest([{_PUSH_FIELDS}]) AS field) c LEFT JOIN fields f USING (field)
        GROUP BY 1""",
    "missing_payload_fields": f"""SELECT field FROM (SELECT unnest([{_ALL_FIELDS}]) AS field)
        WHERE field NOT IN (SELECT field FROM fields WHERE hit)""",
    "array_size_stats": """SELECT count(len(labels)) AS count,
        round(avg(len(labels)), 6) AS mean, round(stddev_samp(len(labels)), 6) AS stddev,
        CAST(min(len(labels)) AS INTEGER) AS min, CAST(max(len(labels)) AS INTEGER) AS max
        FROM raw WHERE type = 'PullRequestEvent'""",
    "array_field_profile": """
        SELECT type, 'labels' AS field, count(len(labels)) AS events_with_data,
          round(avg(len(labels)), 4) AS avg_size, CAST(max(len(labels)) AS INTEGER) AS max_size
          FROM raw WHERE labels IS NOT NULL GROUP BY 1
        UNION ALL
        SELECT type, 'assignees', count(*), round(avg(n_assignees), 4),
          CAST(max(n_assignees) AS INTEGER) FROM raw WHERE n_assignees IS NOT NULL GROUP BY 1""",
    "key_skew_by_digest": """
        SELECT CAST('0x' || substr(md5(actor_login), 1, 8) AS BIGINT) % 8 AS bucket,
          count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows, max(n) AS largest_key_rows
        FROM (SELECT actor_login, count(*) AS n FROM raw GROUP BY 1) GROUP BY 1""",
    "heaviest_key": "SELECT * FROM actors ORDER BY event_count DESC, actor_login LIMIT 1",
}

ORACLE_SQL: dict[str, str] = {name: _WITH + body for name, body in _BODIES.items()}
