"""Maps the flat ``events`` test table to the nested raw shape.

The rules are those of FIXTURES.md section 3, so that a SQL engine can derive the
same rows independently. On top of them pull requests and issues with ``k % 8 = 0``
carry an empty label array, and payloads hold the usual fields of their type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.scratch import file_store

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

# Test event type to raw event type.
_TYPE = """
    CASE event_type
      WHEN 'purchase' THEN 'PullRequestEvent'
      WHEN 'signup' THEN 'IssuesEvent'
      WHEN 'view' THEN 'PushEvent'
      WHEN 'click' THEN 'WatchEvent'
      WHEN 'error' THEN 'CreateEvent'
    END"""

_LOGIN = """
    CASE WHEN k < 6 THEN 'ci-runner[bot]'
      WHEN user_id % 10 = 0 THEN concat('user', user_id, '[bot]')
      ELSE concat('user', user_id)
    END"""

_ACCOUNT = """
    named_struct('id', {id}, 'login', {login}, 'display_login', {login},
      'avatar_url', concat('avatars/', {id}), 'gravatar_id', '',
      'url', concat('users/', {login}))"""

_THREAD = "type IN ('PullRequestEvent', 'IssuesEvent')"

# to_json leaves NULL fields out, so each type shows only its own fields.
_PAYLOAD = f"""
    to_json(named_struct(
      'action', CASE WHEN type = 'WatchEvent' THEN 'started'
        WHEN {_THREAD} THEN if(k % 2 = 0, 'opened', 'closed') END,
      'assignees', CASE WHEN {_THREAD} AND k % 5 = 0 THEN
        transform(sequence(1, 1 + k % 2), i -> named_struct('login', concat('user', i))) END,
      'before', CASE WHEN type = 'PushEvent' THEN concat('b', event_id) END,
      'head', CASE WHEN type = 'PushEvent' AND k % 20 <> 0 THEN concat('h', event_id) END,
      'labels', CASE WHEN {_THREAD} AND (k % 4 > 0 OR k % 8 = 0) THEN
        transform(slice(sequence(1, 4), 1, int(k % 4)), i -> named_struct(
          'name', concat('l', (k + i) % 2), 'color', concat('c', (k + i) % 2))) END,
      'master_branch', CASE WHEN type = 'CreateEvent' THEN 'main' END,
      'number', CASE WHEN {_THREAD} THEN event_id END,
      'push_id', CASE WHEN type = 'PushEvent' THEN event_id END,
      'pusher_type', CASE WHEN type = 'CreateEvent' THEN 'user' END,
      'ref', CASE WHEN type IN ('PushEvent', 'CreateEvent') THEN
        concat('refs/heads/b', k % 5) END,
      'ref_type', CASE WHEN type = 'CreateEvent' THEN 'branch' END,
      'repository_id', CASE WHEN type = 'PushEvent' THEN k END))"""


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame) -> DataFrame:
    """Events dealt evenly over the shuffle partitions.

    Raw lines cost far more to build than the compact table costs to read, whose few
    splits would otherwise hold all that work in as many tasks.
    """
    return events.repartition(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def envelope(events: DataFrame, redelivered: bool = False) -> DataFrame:
    """Raw rows (without the broken-line column).

    ``redelivered`` repeats every tenth event, as when two files hold it.
    """
    if redelivered:
        events = events.selectExpr(
            "*", "explode(if(event_id % 10 = 0, array(0, 1), array(0))) AS copy"
        )
    based = events.selectExpr(
        "event_id", "user_id", "ts", f"{_TYPE} AS type",
        "bigint(get_json_object(props, '$.k')) AS k",
    )
    user = _ACCOUNT.format(id="if(k < 6, 0L, user_id)", login=_LOGIN)
    org = _ACCOUNT.format(id="k % 7", login="concat('org', k % 7)")
    return based.selectExpr(
        "string(event_id) AS id",
        "type",
        f"{user} AS actor",
        """named_struct('id', k, 'name', concat('org', k % 7, '/repo', k),
             'url', concat('repos/', k)) AS repo""",
        f"CASE WHEN event_id % 25 = 0 THEN {org} END AS org",
        "event_id % 1000 <> 0 AS public",
        "concat(replace(substr(string(ts), 1, 19), ' ', 'T'), 'Z') AS created_at",
        f"parse_json({_PAYLOAD}) AS payload",
    )


def raw_lines(envelope_rows: DataFrame) -> DataFrame:
    """Raw rows as the text lines of a raw file, payload as a nested object."""
    names = [c for c in envelope_rows.columns if c != "payload"]
    opened = F.rtrim(F.to_json(F.struct(*names)), F.lit("}"))
    # created_at is the last named field and always there, so one brace was removed.
    line = F.concat(opened, F.lit(',"payload":'), F.to_json("payload"), F.lit("}"))
    return envelope_rows.select(line.alias("value"), "id")


def write_raw_lines(lines: DataFrame, path: str) -> None:
    """Lines as gzip text, a file for each hour, with names as in the manifest.

    An hour is brought together first and split again by size at run time; further files
    of one hour get a number. Spark names files itself, so each is renamed after the
    write: one call to the file system per file.
    """
    stamp = F.get_json_object("value", "$.created_at")
    hour = F.concat(F.substring(stamp, 1, 10), F.lit("-"), F.substring(stamp, 12, 2).cast("int"))
    (
        lines.select("value", F.coalesce(hour, F.lit("unknown")).alias("of"))
        .hint("rebalance", "of")
        .sortWithinPartitions("of")
        .write.mode("overwrite")
        .partitionBy("of")
        .option("compression", "gzip")
        .text(path)
    )
    spark = lines.sparkSession
    root, store = file_store(spark, path)
    for folder in store.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith("of="):
            for n, file in enumerate(store.listStatus(folder.getPath())):
                suffix = f".{n}" if n else ""
                target, _ = file_store(spark, f"{path}/{name.removeprefix('of=')}{suffix}.json.gz")
                store.rename(file.getPath(), target)
            store.delete(folder.getPath(), True)


def break_some_lines(lines: DataFrame) -> DataFrame:
    """Cuts the end off every hundredth line, as an interrupted download would."""
    return lines.selectExpr(
        "if(bigint(id) % 100 = 7, substr(value, 1, length(value) - 5), value) AS value", "id"
    )


def write_heartbeat(envelope_rows: DataFrame, days: int, path: str) -> None:
    """A raw file with one event that only tells the time: some days after the last one."""
    pattern = F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")
    later = F.to_timestamp_ntz(F.max("created_at"), pattern) + F.make_dt_interval(F.lit(days))
    last = envelope_rows.agg(later.alias("t")).filter("t IS NOT NULL")
    stamp = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at")
    line = F.to_json(F.struct(F.lit("Heartbeat").alias("type"), stamp))
    write_raw_lines(last.select(line.alias("value")), path)


def add_payload_field(envelope_rows: DataFrame) -> DataFrame:
    """On every third day of a month payloads have one more field, on every ninth as text."""
    day = F.substring("created_at", 9, 2).cast("int")
    value = F.when(day % 9 == 0, F.concat(F.lit('"'), F.col("id"), F.lit('"'))).otherwise(F.col("id"))
    more = F.concat(F.lit('{"novel":'), value, F.lit(","), F.substring(F.to_json("payload"), 2, 2**30))
    return envelope_rows.withColumn("payload", F.when(day % 3 == 0, F.parse_json(more)).otherwise(F.col("payload")))


def cut_some_hours(lines: DataFrame) -> DataFrame:
    """Leaves a quarter of the lines of every 29th hour, as when a download breaks off."""
    stamp = F.get_json_object("value", "$.created_at")
    hour = F.substring(stamp, 9, 2).cast("int") * 24 + F.substring(stamp, 12, 2).cast("int")
    return lines.filter((hour % 29 != 3) | (F.col("id").cast("bigint") % 4 == 0))


def add_unknown_fields(lines: DataFrame) -> DataFrame:
    """Gives every fiftieth line a field the schema does not know, and one in its actor."""
    more = F.regexp_replace(F.substring("value", 2, 2**30), '"actor":\\{', '"actor":{"plan":"p",')
    more = F.concat(F.lit('{"novel":'), F.col("id"), F.lit(","), more)
    return lines.withColumn("value", F.when(F.col("id").cast("bigint") % 50 == 0, more).otherwise(F.col("value")))
