"""What the operators of this subpackage have in common."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import eventlake
from eventlake.sources.scratch import scratch_path

#: Bytes of white space that end a word: space and tab to carriage return. This is
#: what ``bytes.split()`` and ``bytes.strip()`` take as white space too.
WHITE = b" \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared scratch folder and reads it back.

    Cuts the lineage: what follows survives lost executors without running the steps
    before again, and values such as partition ids stay as they were written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share_code(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    It matters in local mode and where all machines see the same folders; elsewhere the
    package is shipped with the application, as with ``--py-files``.
    """
    root = str(Path(eventlake.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_batches(df: DataFrame, task: Callable, schema) -> DataFrame:
    """``mapInArrow`` with code of this package; for ``DataFrame.transform``."""
    share_code(df.sparkSession)
    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists that stem from about ``size`` bytes."""
    start, end = 0, len(data)
    while start < end:
        stop = min(start + size, end)
        while stop < end and data[stop] not in WHITE:
            stop += 1
        yield data[start:stop].split()
        start = stop


def in_order(rows: DataFrame, *order: Column, weight: Column | None = None) -> DataFrame:
    """Adds ``pos``, the gapless place of each row in a global order, from 0,
    ``before``, the sum of ``weight`` over all rows ahead of it, and ``total``, that
    over all rows.

    The rows are range-partitioned and written once. A prefix sum over the totals of
    the partitions (a few numbers each) gives every partition its offset, and a window
    inside the partition the rest. ``order`` should be unique: then no group of equal
    keys is too large for a partition, and the order is the same on every run. Rows
    should be narrow, since they are shuffled twice.
    """
    weight = F.lit(0).cast("long") if weight is None else weight
    parts = stored(
        rows.withColumn("weight_", weight)
        .repartitionByRange(*order)
        .withColumn("part_", F.spark_partition_id()),
        "ordered",
    )
    totals = parts.groupBy("part_").agg(
        F.count(F.lit(1)).alias("rows_"), F.sum("weight_").alias("sum_")
    )
    ahead = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part_",
        F.coalesce(F.sum("rows_").over(ahead), F.lit(0)).alias("first_"),
        F.coalesce(F.sum("sum_").over(ahead), F.lit(0)).alias("base_"),
        F.sum("sum_").over(
            Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("total"),
    )
    inside = Window.partitionBy("part_").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row for each partition of the exchange above: bounded by its partition count.
    return (
        parts.join(F.broadcast(offsets), "part_")
        .withColumn("pos", F.col("first_") + F.row_number().over(inside) - 1)
        .withColumn("before", F.col("base_") + F.sum("weight_").over(upto) - F.col("weight_"))
        .drop("part_", "first_", "base_", "weight_")
    )


def scan_array(items: Column, zero: Column, step, out_type: str, block: int = 128) -> Column:
    """``step(state, item)`` gives struct(state, out) in turn; returns all outs in order.

    Blocks keep it linear: appending to an array copies it.
    """
    none = F.array().cast(f"array<{out_type}>")
    starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / block).cast("int"))
    blocks = F.transform(starts, lambda i: F.slice(items, i * block + 1, block))

    def over_block(acc, chunk):
        def one(a, x):
            return _append(step(a["state"], x), a["out"])

        return F.aggregate(
            chunk,
            F.struct(acc["state"].alias("state"), none.alias("out")),
            one,
            lambda a: F.struct(
                a["state"].alias("state"), F.concat(acc["out"], F.array(a["out"])).alias("out")
            ),
        )

    nested = F.aggregate(
        blocks,
        F.struct(zero.alias("state"), F.array().cast(f"array<array<{out_type}>>").alias("out")),
        over_block,
        lambda a: F.flatten(a["out"]),
    )
    return F.when(F.size(items) > 0, nested).otherwise(none)


def _append(got: Column, out: Column) -> Column:
    # transform over one element evaluates ``got`` once.
    return F.transform(
        F.array(got),
        lambda g: F.struct(g["state"].alias("state"), F.concat(out, g["outs"]).alias("out")),
    )[0]


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a shared folder and the path in it: a URI, or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)
