"""Picks up raw files that were not read before and adds them to stored tables.

The file source remembers in its checkpoint which files it has read, so running it
again over the same folder adds nothing, and a run that dies goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.bronze import bronze, broken_lines, is_broken
from eventlake.operators.keep import shared
from eventlake.sources.raw import parse_lines

BATCH = "batch"


def new_raw_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw files of a folder as a stream, by the fixed schema."""
    lines = (
        spark.readStream.option("pathGlobFilter", "*.json.gz")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
    )
    return parse_lines(lines.withColumn("source_file", F.col("_metadata.file_name")), "source_file")


def write_batch(rows: DataFrame, number: int, path: str, *by: str) -> None:
    """Rows of one batch to directories of its own, which they replace."""
    order = [c for c in ("event_date", "type") if c in rows.columns]
    ordered = rows.sortWithinPartitions(*order) if order else rows
    (
        ordered.withColumn(BATCH, F.lit(number))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, BATCH)
        .parquet(path)
    )


def store_batch(target: str):
    """Writes one batch of parsed lines: events to Bronze, broken lines aside.

    Both tables have a directory per batch number and the batch replaces its own, so a
    batch that is run again after a failure leaves nothing twice.
    """

    def run(rows: DataFrame, number: int) -> None:
        with shared(rows.withColumn("broken", is_broken(rows))) as marked:
            good = bronze(marked.filter(~F.col("broken")).drop("broken", "source_file"))
            aside = broken_lines(marked.filter("broken").drop("broken"))
            for part, name in ((good, "bronze"), (aside, "quarantine")):
                write_batch(part, number, f"{target}/{name}", *(["event_date"] if name == "bronze" else []))

    return run


def ingest_new_files(
    spark: SparkSession, folder: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Reads everything new once: events to ``target/bronze``, broken lines aside.

    One query, so each file is listed and parsed once; the parsed batch is kept while its
    two parts are written. The tables belong to this stream alone; the batch jobs read
    them like any other layer but must not overwrite them. Duplicates between files
    stay, as in batch Bronze, and are removed by Silver.
    """
    query = (
        new_raw_lines(spark, folder)
        .writeStream.foreachBatch(store_batch(target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
