"""Sharding: contiguous shards of nearly equal bytes.

Rows get a global order and, from per-partition totals, the bytes ahead of each. Shards
are cut at equal targets: a row belongs to the shard in which its middle byte falls. So
a shard misses its target by a row's size at most, whatever the order or the hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import in_order, text_or_empty


def cut(rows: DataFrame, size: Column, shards: int, *order: Column) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in its shard).

    Rows should be narrow and ``order`` unique. Sizes must not be negative; the last
    shard takes rows of size 0 at the end.
    """
    placed = in_order(rows.withColumn("size_", size), *order, weight=F.col("size_"))
    middle = (2 * F.col("before") + F.col("size_")).cast("decimal(20,0)") * F.lit(shards).cast("decimal(10,0)")
    shard = F.when(
        F.col("total") > 0,
        F.least(F.floor(middle / (2 * F.col("total"))).cast("int"), F.lit(shards - 1)),
    ).otherwise(F.lit(0))
    dealt = placed.withColumn("shard", shard).drop("total", "before", "size_")
    # One row per shard, so at most ``shards`` of them.
    first = dealt.groupBy("shard").agg(F.min("pos").alias("first_"))
    return (
        dealt.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("pos") - F.col("first_"))
        .drop("first_", "pos")
    )


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus 16),
    text_crc32, law, shard, slot, grown_shard.

    Rows are ordered by a hash of the text, then doc_id, so equal texts lie side by side
    and mostly in one shard; a group of copies larger than a shard is cut like anything
    else. A null text counts as empty. Rows equal in text and doc_id are interchangeable;
    a last random number keeps any number of them from one partition. An empty table
    gives no rows. Further columns are not looked at.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash_"),
    ).withColumn("tie_", F.monotonically_increasing_id())
    placed = cut(rows, F.col("size"), shards, F.col("hash_"), F.col("doc_id"), F.col("tie_"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> DataFrame:
    """Writes each shard of the documents as a folder ``shard=N``, ordered by ``slot``.

    Rows that share doc_id and text take the slots of their key in any order.
    """
    text = text_or_empty()
    rows = docs.withColumns({"hash_": F.xxhash64(text), "size_": (F.octet_length(text) + 16).cast("long")})
    keys = rows.groupBy("doc_id", "hash_").agg(
        F.sum("size_").alias("bytes_"), F.count(F.lit(1)).alias("n_")
    )
    placed = cut(keys, F.col("bytes_"), shards, F.col("hash_"), F.col("doc_id"))
    placed = placed.select(
        F.col("doc_id").alias("id_"), F.col("hash_").alias("key_"), "shard", "slot"
    )
    joined = rows.join(placed, rows.doc_id.eqNullSafe(placed.id_) & (rows.hash_ == placed.key_))
    out = joined.select(*docs.columns, "shard", "slot").repartition("shard").sortWithinPartitions("shard", "slot")
    out.write.mode("overwrite").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
