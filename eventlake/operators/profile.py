"""Data profiling over raw or Bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import payload as P
from eventlake.functions.measures import percent, ratio
from eventlake.operators.keep import count_by, top
from eventlake.schema import PAYLOAD_ARRAYS, PULL_REQUEST, PUSH, PUSH_CANDIDATES, TOP_N


def core_projection(raw: DataFrame) -> DataFrame:
    """The nine columns most reports need; no payload."""
    return raw.select(
        F.col("id").alias("event_id"),
        "type",
        F.col("actor.login").alias("actor_login"),
        F.col("actor.id").alias("actor_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("repo.id").alias("repo_id"),
        "org",
        "public",
        "created_at",
    )


def nested_select(raw: DataFrame) -> DataFrame:
    """Nested fields by path; the result columns are named login and name."""
    return raw.select("type", "actor.login", "repo.name", "created_at")


def total_events(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_events"))


def events_by_type(df: DataFrame) -> DataFrame:
    return count_by(df, "type").orderBy(F.desc("event_count"), "type")


def push_event_count(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type") == PUSH).agg(F.count(F.lit(1)).alias("push_events"))


def public_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "public")


def created_at_range(df: DataFrame) -> DataFrame:
    """Smallest and largest created_at, as text."""
    return df.agg(
        F.min("created_at").alias("min_ts"), F.max("created_at").alias("max_ts")
    )


def org_null_ratio(df: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    nulls = total - F.count("org")
    return df.agg(
        total.alias("total_events"),
        nulls.alias("org_null"),
        ratio(nulls, total).alias("org_null_ratio"),
    )


def duplicate_ids(core: DataFrame) -> DataFrame:
    """How many ids occur more than once."""
    seen = count_by(core.select("event_id"), "event_id", name="n")
    return seen.filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("duplicate_ids"))


def distinct_event_count(events: DataFrame) -> DataFrame:
    """Number of distinct events; a NULL id counts as one."""
    ids = events.select("event_id").distinct()
    return ids.agg(F.count(F.lit(1)).alias("distinct_events"))


def group_count(df: DataFrame, key: str) -> DataFrame:
    """Number of groups a grouping by the key has, NULL being one."""
    return count_by(df, key).agg(F.count(F.lit(1)).alias("groups"))


def cardinalities(core: DataFrame, columns: Sequence[str] = ("actor_login", "repo_name")) -> DataFrame:
    """Distinct values of each column, NULL counting as a value.

    Each column is its own one-column scan with distinct done partially per task.
    """
    parts = [
        core.select(c).distinct().agg(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("distinct_values")
        )
        for c in columns
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def type_share(df: DataFrame) -> DataFrame:
    return _with_share(count_by(df, "type")).orderBy(F.desc("event_count"), "type")


def actor_share(events: DataFrame, n: int = TOP_N) -> DataFrame:
    """The busiest actors with their share of all events."""
    counts = count_by(events, "actor_login")
    return top(_with_share(counts), n, "event_count", "actor_login")


def _with_share(counts: DataFrame) -> DataFrame:
    # A scalar subquery over the counts: a window without partitions would bring
    # every group to one task. Spark reuses the shuffle below for both.
    whole = counts.agg(F.sum("event_count")).scalar()
    return counts.withColumn("share_pct", percent(F.col("event_count"), whole))


def top_level_fields(lines: DataFrame) -> DataFrame:
    """Top-level fields of raw text lines and how many lines have each.

    The fixed schema keeps fields it does not know apart; this report shows all.
    """
    return count_by(lines.select(F.explode(F.json_object_keys("value")).alias("field")), "field")


# Payload


def payload_keys_by_type(raw: DataFrame) -> DataFrame:
    """How often each top-level payload field occurs in each type."""
    keyed = raw.select("type", F.explode(P.keys()).alias("field"))
    return count_by(keyed, "type", "field")


def payload_union_schema(raw: DataFrame) -> DataFrame:
    """Every payload field with its type merged over all records.

    Types merge partially per task; the state is one schema per field.
    """
    fields = raw.select(F.col("payload").alias("v")).lateralJoin(
        raw.sparkSession.tvf.variant_explode(F.col("v").outer())
    )
    return fields.groupBy(F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("field_type"),
        F.count(F.lit(1)).alias("event_count"),
    )


def payload_field_kinds(raw: DataFrame) -> DataFrame:
    """The same with the outermost kind only: STRING, BIGINT, ARRAY, OBJECT, ..."""
    return payload_union_schema(raw).select(
        "field",
        F.regexp_extract("field_type", "^[A-Z]+", 0).alias("kind"),
        "event_count",
    )


def payload_kinds_by_date(bronze: DataFrame) -> DataFrame:
    """(event_date, field, kinds): the outermost kinds each payload field has on a date, sorted.

    At most a few kinds a field. Null values have no kind. Dates can be made one by one and
    put together, as with ``write_by_date``.
    """
    rows = bronze.select("event_date", F.col("payload").alias("v"))
    fields = rows.lateralJoin(bronze.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    seen = fields.select("event_date", F.col("key").alias("field"), kind.alias("kind"))
    return (
        seen.filter(F.col("kind") != "VOID")
        .groupBy("event_date", "field")
        .agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"))
    )


def schema_changes(kinds: DataFrame) -> DataFrame:
    """What differs from the date before that has events: fields gained, lost, and changed.

    A row a date, field and change; the input has a row a date and field. The first date has
    nothing to be compared with. Rows without a date are left out.
    """
    dated = kinds.filter(F.col("event_date").isNotNull())
    # One row a date: bounded by the dates.
    order = Window.orderBy("event_date")
    dates = dated.select("event_date").distinct().withColumn("after", F.lead("event_date").over(order))
    before = dated.join(dates, "event_date").filter(F.col("after").isNotNull()).select(
        F.col("after").alias("event_date"), "field", F.col("kinds").alias("kinds_before")
    )
    first = dates.agg(F.min("event_date")).scalar()
    both = dated.join(before, ["event_date", "field"], "full").filter(F.col("event_date") > first)
    change = (
        F.when(F.col("kinds_before").isNull(), "gained")
        .when(F.col("kinds").isNull(), "lost")
        .when(F.col("kinds") != F.col("kinds_before"), "changed")
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        "event_date", "field", "change", "kinds_before", "kinds"
    )


def record_union_schema(lines: DataFrame) -> DataFrame:
    """Every field of whole lines and of their accounts and repositories, with its type
    merged over all records; nested names are dotted."""
    parsed = F.try_parse_json("value")
    parts = F.array(
        F.struct(F.lit("").alias("prefix"), parsed.alias("v")),
        *(
            F.struct(F.lit(f"{n}.").alias("prefix"), F.try_variant_get(parsed, f"$.{n}", "variant").alias("v"))
            for n in ("actor", "repo", "org")
        ),
    )
    rows = lines.select(F.inline(parts)).filter(F.col("v").isNotNull())
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return fields.groupBy(F.concat("prefix", "key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("field_type"),
        F.count(F.lit(1)).alias("event_count"),
    )


def record_union_kinds(lines: DataFrame) -> DataFrame:
    """The same with the outermost kind only."""
    return record_union_schema(lines).select(
        "field", F.regexp_extract("field_type", "^[A-Z]+", 0).alias("kind"), "event_count"
    )


def payload_field_presence(
    raw: DataFrame, type_name: str = PUSH, names: Sequence[str] = PUSH_CANDIDATES
) -> DataFrame:
    """For each candidate field: known to any type at all, and filled in this type.

    One scan and one aggregate for all fields.
    """
    of_type = F.col("type") == type_name
    parsed = raw.select(
        of_type.alias("hit"),
        P.keys().alias("keys"),
        F.when(of_type, P.fields(names)).alias("f"),
    )
    total = F.count_if("hit")
    row = parsed.agg(
        F.array(
            *(
                F.struct(
                    F.lit(n).alias("field"),
                    P.key_seen("keys", n).alias("in_schema"),
                    F.count(F.col("f")[n]).alias("non_null"),
                    total.alias("total"),
                )
                for n in names
            )
        ).alias("rows")
    )
    return row.select(F.inline("rows")).withColumn(
        "non_null_ratio", ratio(F.col("non_null"), F.col("total"))
    )


def array_sizes(raw: DataFrame, names: Sequence[str], *keep: str) -> DataFrame:
    """Length of each named payload array, NULL (never -1) where it is absent.

    The payload is decoded once for all names.
    """
    decoded = raw.select("type", *keep, P.arrays(names).alias("arrays"))
    return decoded.select(
        "type", *keep, *(F.array_size(f"arrays.{n}").alias(n) for n in names)
    )


def array_field_profile(
    raw: DataFrame, names: Sequence[str] = PAYLOAD_ARRAYS
) -> DataFrame:
    """For each array field and type: events with it, mean and largest length.

    Grouped by type only, with every field as a set of aggregates, so no row is
    multiplied by the number of fields.
    """
    sized = array_sizes(raw, names)
    per_type = sized.groupBy("type").agg(
        F.array(
            *(
                F.struct(
                    F.lit(n).alias("field"),
                    F.count(n).alias("events_with_data"),
                    F.round(F.avg(n), 4).alias("avg_size"),
                    F.max(n).alias("max_size"),
                )
                for n in names
            )
        ).alias("rows")
    )
    return per_type.select("type", F.inline("rows")).filter("events_with_data > 0")


def array_size_stats(raw: DataFrame, type_name: str = PULL_REQUEST, name: str = "labels") -> DataFrame:
    """Summary of one array field's length within one type; NULL arrays are left out."""
    sized = array_sizes(raw.filter(F.col("type") == type_name), [name])
    return sized.agg(
        F.count(name).alias("count"),
        F.round(F.avg(name), 6).alias("mean"),
        F.round(F.stddev_samp(name), 6).alias("stddev"),
        F.min(name).alias("min"),
        F.max(name).alias("max"),
    )
