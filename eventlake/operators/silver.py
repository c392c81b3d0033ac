"""Bronze to Silver: flat columns, one row for each event and pull request label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.payload import pr_labels
from eventlake.functions.timestamps import parse_utc
from eventlake.operators.keep import one_row_per
from eventlake.schema import EVENT_COLUMNS, PULL_REQUEST, SILVER_COLUMNS


def _flat() -> list[str | Column]:
    return [
        F.col("id").alias("event_id"),
        "type",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("org.login").alias("org_login"),
        "public",
        parse_utc("created_at").alias("created_at"),
        "event_date",
    ]


def _is_pull_request() -> Column:
    return F.col("type").eqNullSafe(PULL_REQUEST)


def flatten(bronze: DataFrame) -> DataFrame:
    """Nested fields as prefixed columns at event grain, without the payload."""
    return bronze.select(*_flat())


def gate_labels(bronze: DataFrame) -> DataFrame:
    """Flat events plus ``pr_labels``, which only pull requests may fill."""
    return bronze.select(*_flat(), pr_labels().alias("pr_labels"))


def explode_labels(gated: DataFrame) -> DataFrame:
    """One row per label; an event with a NULL or empty array keeps one row."""
    return gated.select(
        *EVENT_COLUMNS, F.explode_outer("pr_labels").alias("label")
    ).select(
        *EVENT_COLUMNS,
        F.col("label.name").alias("pr_label_name"),
        F.col("label.color").alias("pr_label_color"),
    )


def labels_inner(gated: DataFrame) -> DataFrame:
    """One row per label; events without labels disappear."""
    return gated.select("event_id", F.explode("pr_labels").alias("label")).select(
        "event_id",
        F.col("label.name").alias("pr_label_name"),
        F.col("label.color").alias("pr_label_color"),
    )


def silver(bronze: DataFrame) -> DataFrame:
    """The Silver rows: unique by (event_id, pr_label_name), lowest colour kept.

    An event belongs to the earliest date any of its copies has (NULL last), and only
    its copies of that date count. Only pull requests can hold more than one row, so
    the two kinds of event take separate paths. All others never touch the payload
    column, by far the widest in Bronze, and the pull request path reads it only in the
    row groups that hold pull requests (Bronze is sorted by type). This needs ``type``
    to be the same in every copy of an event.
    """
    return silver_marked(bronze).drop("opens_event")


def silver_marked(bronze: DataFrame) -> DataFrame:
    """``silver`` plus ``opens_event``, true in exactly one row of each event."""
    others = one_row_per(
        flatten(bronze.filter(~_is_pull_request())), ["event_id"], lowest=["event_date", "created_at"]
    )
    none = F.lit(None).cast("string")
    others = others.select(
        *EVENT_COLUMNS, none.alias("pr_label_name"), none.alias("pr_label_color"),
        F.lit(True).alias("opens_event"),
    )
    exploded = explode_labels(gate_labels(bronze.filter(_is_pull_request())))
    pulls = one_row_per(
        exploded, ["event_id", "pr_label_name", "event_date"], lowest=["pr_label_color", "created_at"]
    )
    # Copies have collapsed by now: an event has a row for each label and date.
    copies = Window.partitionBy("event_id")
    by_date = copies.orderBy(F.col("event_date").isNull(), "event_date")
    first = F.first("event_date").over(by_date)
    pulls = pulls.withColumn("first_date", first).filter(F.col("event_date").eqNullSafe(F.col("first_date")))
    opens = F.row_number().over(copies.orderBy("pr_label_name")) == 1
    return others.unionByName(pulls.select(*SILVER_COLUMNS, opens.alias("opens_event")))


def event_table(marked: DataFrame) -> DataFrame:
    """One row an event of ``silver_marked`` rows, which needs no shuffle: event grain as it is
    stored, for all that does not ask for labels."""
    return marked.filter("opens_event").select(*EVENT_COLUMNS)


def label_table(marked: DataFrame) -> DataFrame:
    """(event_id, event_date, name, colour), one row for each event and label.

    A label without a name is kept where the event has others too; alone it is the same
    as no label.
    """
    own = Window.partitionBy("event_id")
    pulls = marked.filter(_is_pull_request()).withColumn("rows", F.count(F.lit(1)).over(own))
    named = F.col("pr_label_name").isNotNull() | F.col("pr_label_color").isNotNull() | (F.col("rows") > 1)
    return pulls.filter(named).select("event_id", "event_date", "pr_label_name", "pr_label_color")


def silver_view(event_rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Silver put together from the two tables; only pull requests look for labels."""
    pulls = event_rows.filter(_is_pull_request())
    theirs = labels.select(F.col("event_id").alias("of"), "pr_label_name", "pr_label_color")
    labelled = pulls.join(theirs, F.col("event_id").eqNullSafe(F.col("of")), "left").select(*SILVER_COLUMNS)
    none = F.lit(None).cast("string")
    others = event_rows.filter(~_is_pull_request()).select(
        *EVENT_COLUMNS, none.alias("pr_label_name"), none.alias("pr_label_color")
    )
    return others.unionByName(labelled)


def events(bronze: DataFrame, *columns: str) -> DataFrame:
    """Event grain straight from Bronze: one row per event_id.

    The same events as ``event_grain(silver(bronze))`` with one shuffle and no
    payload. Name the columns you need; ``event_id`` is always kept.
    """
    wanted = columns or EVENT_COLUMNS[1:]
    return one_row_per(
        flatten(bronze).select("event_id", *(c for c in wanted if c != "event_id")),
        ["event_id"],
        lowest=[c for c in ("event_date", "created_at") if c in wanted],
    )


def event_grain(silver_rows: DataFrame, *columns: str) -> DataFrame:
    """Event grain from stored Silver rows.

    Silver is unique by (event_id, pr_label_name) and only pull requests have
    labels, so every other row is its event already and is passed on as it is;
    only the pull request rows are shuffled.
    """
    wanted = columns or EVENT_COLUMNS[1:]
    names = ["event_id", *(c for c in wanted if c != "event_id")]
    others = silver_rows.filter(~_is_pull_request()).select(*names)
    pulls = silver_rows.filter(_is_pull_request()).select(*names)
    return others.unionByName(one_row_per(pulls, ["event_id"]))
