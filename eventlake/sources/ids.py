"""Index of the event ids of Silver: which date holds an event.

The index is stored in buckets by id, so that a join on the id reads it as it lies: only the
new rows are shuffled, however long the history is. Null ids are one event, and buckets
need a key that is never null, so ids are stored with a mark in front.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.schema import SILVER_SCHEMA
from eventlake.sources.layers import date_folder, read_layer
from eventlake.sources.manifest import changes, in_days, note
from eventlake.sources.scratch import file_store

KEY = "id_key"
#: Also the number of tasks of a join with the index. It names the folder, so an index
#: with another number of buckets is made anew.
BUCKETS = 64


def id_key(column: str = "event_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


class IdIndex:
    """The index of ``lake/silver``; ``refresh`` brings it up to date."""

    def __init__(self, spark: SparkSession, lake: str, buckets: int = BUCKETS):
        self.spark, self.lake, self.buckets = spark, lake, buckets
        self.path = f"{lake}/silver_ids/buckets-{buckets}"
        self.name = f"eventlake_ids_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def _table(self) -> None:
        """Makes the stored files known to this session's catalog; moves no data."""
        where, _ = file_store(self.spark, f"{self.path}/rows")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(
            f"""CREATE TABLE {self.name} ({KEY} STRING, event_date DATE) USING parquet
              PARTITIONED BY (event_date) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS
              LOCATION '{str(where).replace("'", "''")}'"""
        )
        if where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def refresh(self) -> frozenset[date | None]:
        """Replaces the dates whose Silver files have changed; returns them.

        An interrupted refresh leaves no note, so the next one does these dates again.
        """
        silver = f"{self.lake}/silver"
        found = changes(self.spark, silver, f"{self.path}/made_from")
        for day in found.days:
            where, store = file_store(self.spark, f"{self.path}/rows/{date_folder(day)}")
            store.delete(where, True)
        self._table()
        if found.days:
            rows = read_layer(self.spark, silver, schema=SILVER_SCHEMA).filter(in_days(found.days))
            ids = rows.select(id_key().alias(KEY), "event_date").distinct()
            # Dealt like the buckets, so that a bucket and date is one file.
            ids.repartition(self.buckets, KEY).sortWithinPartitions("event_date", KEY).write.insertInto(self.name)
            note(self.spark, found, f"{self.path}/made_from")
        return found.days

    def rows(self) -> DataFrame:
        """(id_key, event_date), one row an event."""
        return self.spark.table(self.name)


def not_in(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows whose event is not among the index rows ``held``; only ``rows`` are shuffled."""
    keyed = rows.withColumn(KEY, id_key())
    return keyed.join(held.select(KEY), KEY, "left_anti").select(*rows.columns)
