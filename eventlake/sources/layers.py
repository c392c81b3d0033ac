"""Parquet layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.bronze import in_dates
from eventlake.sources.scratch import file_store


def write_by_date(
    df: DataFrame,
    path: str,
    *,
    only: Callable[[date | None], bool] | None = None,
    gather: bool = False,
    sort_by: Sequence[str] = ("type",),
) -> None:
    """Overwrite a layer, one directory per event_date.

    ``only`` tells which dates are replaced, and ``df`` holds no others; a date for which
    ``df`` has no rows loses its directory. Without it, the whole layer is replaced.
    ``gather`` brings each date together first, split again by size at run time; use it
    after a shuffle by some other key, where every task would else write a small file
    for every date. Rows are sorted inside each file, which the partitioned write has to
    do anyway; readers that filter on ``sort_by`` then skip whole row groups.
    """
    if gather:
        df = df.hint("rebalance", "event_date")
    before = date_files(df.sparkSession, path) if only else {}
    (
        df.sortWithinPartitions("event_date", *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only else "static")
        .partitionBy("event_date")
        .parquet(path)
    )
    if only:
        after = date_files(df.sparkSession, path)
        for day, files in before.items():
            # A date that was written again has new files; one that was not is stale.
            if only(day) and after.get(day) == files:
                where, store = file_store(df.sparkSession, f"{path}/{date_folder(day)}")
                store.delete(where, True)


def date_folder(day: date | None) -> str:
    return f"event_date={day or '__HIVE_DEFAULT_PARTITION__'}"


def date_files(spark: SparkSession, path: str) -> dict[date | None, frozenset[str]]:
    """Names of the files of each date; a listing, no data is read."""
    where, store = file_store(spark, path)
    if not store.exists(where):
        return {}
    found = {}
    for folder in store.listStatus(where):
        name = folder.getPath().getName()
        if name.startswith("event_date="):
            value = name.partition("=")[2]
            day = None if value.startswith("__HIVE") else date.fromisoformat(value)
            found[day] = frozenset(f.getPath().getName() for f in store.listStatus(folder.getPath()))
    return found


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite a small unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def read_layer(
    spark: SparkSession,
    path: str,
    start: date | None = None,
    end: date | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A layer, restricted to a date range by directory when one is given.

    By its ``schema`` it can be read also when it is empty or has undated rows only.
    """
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if start is None and end is None:
        return df
    return df.filter(in_dates(start, end))


def file_layout(spark: SparkSession, path: str) -> DataFrame:
    """Each file of a layer with its date and size, from the listing; no data is read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    )
    return listed.select(
        "event_date",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.round(F.col("length") / (1024 * 1024), 3).alias("size_mb"),
    )


def partition_layout(spark: SparkSession, path: str) -> DataFrame:
    """Files and size of each date directory, from the listing; no data is read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    )
    return (
        listed.groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.round(F.sum("length") / (1024 * 1024), 3).alias("size_mb"),
        )
        .orderBy("event_date")
    )
