"""Raw event files: one JSON object per line, gzip, one file per hour."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.quality import hour_manifest
from eventlake.schema import CORRUPT, KNOWN_FIELDS, LINE_COLUMNS, REST


def read_raw(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files as one table, by the fixed schema, broken lines in one column.

    No inference pass runs, and the schema does not depend on what a day contains; what
    it does not know goes to ``rest``. gzip cannot be split: one task reads at least one
    whole file.
    """
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        raise FileNotFoundError("no raw files given")
    return parse_lines(read_lines(spark, sorted(paths)))


def parse_lines(lines: DataFrame, *keep: str) -> DataFrame:
    """Raw rows from text lines in ``value``; blank lines are none.

    A line is parsed once, to a variant; all columns are taken from that. It is broken if it
    is no JSON object, holds a field twice, or if a field has another kind than the schema.
    """
    line = lines.filter(F.trim("value") != "").select(*keep, "value", _once(F.try_parse_json("value")).alias("v"))
    row = F.try_variant_get("v", "$", f"struct<{LINE_COLUMNS}>")
    typed = line.select(*keep, "value", "v", _once(row).alias("row"))
    names = typed.schema["row"].dataType.names
    payload = F.try_variant_get("v", "$.payload", "variant")
    return typed.select(
        *keep,
        *(f"row.{n}" for n in names),
        F.when(~F.is_variant_null(payload), payload).alias("payload"),
        unknown_fields("v").alias(REST),
        F.when(~_fits(), F.col("value")).alias(CORRUPT),
    )


def _once(value: Column) -> Column:
    """The value as the output of a generator: a filter on it is not pushed below, where
    the optimizer would put a copy of the expression wherever the filter names it."""
    return F.explode(F.array(value))


def _fits() -> Column:
    """Whether every field of the line has the kind its column has, or is absent or null.

    Only what a cast would bend is looked at: numbers and booleans. Text may be written as
    anything, and what should be an object is NULL if it is none.
    """
    def given(path: str) -> Column:
        return F.try_variant_get("v", path, "variant")

    def absent(path: str) -> Column:
        return given(path).isNull() | F.is_variant_null(given(path))

    def of_kind(path: str, kind: str) -> Column:
        return absent(path) | (F.schema_of_variant(given(path)) == kind)

    parts = [F.col("row").isNotNull()]
    parts += [F.col(f"row.{n}").isNotNull() | absent(f"$.{n}") for n in ("actor", "repo", "org")]
    parts += [of_kind(f"$.{n}.id", "BIGINT") for n in ("actor", "repo", "org")]
    parts.append(of_kind("$.public", "BOOLEAN"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole & p
    return F.coalesce(whole, F.lit(False))


def unknown_fields(parsed: str) -> Column:
    """JSON of all fields of a line that the schema does not name; NULL if there are none.

    Looks at the event and the objects whose fields the schema lists; the payload is kept
    whole anyway. Values keep their JSON types.
    """
    def strange(part: str) -> Column:
        path = "$" if part == "event" else f"$.{part}"
        fields = F.try_variant_get(parsed, path, "map<string,variant>")
        unknown = F.map_filter(fields, lambda k, _: ~k.isin(*KNOWN_FIELDS[part]))
        return F.when(F.size(unknown) > 0, unknown)

    parts = {part: strange(part) for part in KNOWN_FIELDS}
    found = F.to_json(F.struct(*(c.alias(part) for part, c in parts.items())))
    return F.when(found != "{}", found)


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The same files as text, one row per line in column ``value``."""
    return spark.read.text(paths)


def lines_per_hour(spark: SparkSession, root: str) -> DataFrame:
    """(event_date, hour, lines) of the raw files by the hour in their names.

    Lines are counted as they are, so that a file that ends too early shows.
    """
    lines = (
        spark.read.option("pathGlobFilter", "*.json.gz").text(root)
        .filter(F.trim("value") != "")
        .groupBy(F.col("_metadata.file_name").alias("file_name"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    part = [F.regexp_extract("file_name", r"^(\d{4}-\d{2}-\d{2})-(\d{1,2})\.", i) for i in (1, 2)]
    hours = lines.select(
        F.expr("try_to_date(regexp_extract(file_name, '^([0-9]{4}-[0-9]{2}-[0-9]{2})-[0-9]{1,2}[.]', 1))").alias("event_date"),
        F.when(part[1] != "", part[1].cast("int")).alias("hour"), "lines",
    )
    return hours.filter(F.col("event_date").isNotNull()).groupBy("event_date", "hour").agg(F.sum("lines").alias("lines"))


def raw_glob(root: str, start: date, end: date) -> str:
    """Path pattern for every hourly file of an inclusive date range."""
    if end < start:
        raise ValueError(f"end {end} lies before start {start}")
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    return f"{root}/{{{','.join(d.isoformat() for d in days)}}}-*.json.gz"


def missing_files(spark: SparkSession, root: str, start: date, end: date) -> DataFrame:
    """Hours of the range that have no raw file under ``root``.

    Only the listing is read; both sides of the join are bounded by the range.
    """
    wanted = hour_manifest(spark, start, end)
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json.gz")
        .load(root)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    return wanted.join(listed, "file_name", "left_anti").select(
        "event_date", "hour", "file_name"
    )
