"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    chat,
    collocations,
    decontaminate,
    divergence,
    hashing,
    lines,
    packing,
    pages,
    secrets,
    sharding,
    simhash,
    tokenfile,
    warc,
)
from eventlake.llm.oracle import ORACLE_SQL  # noqa: F401  for the entry point
from eventlake.llm.shared import table


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), packing.public_tokenizer())


def op8_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.counted(spark, table(spark, sf_dir, "documents"), tokenfile.public_ranks())


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings of a common template."""
    told = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"),
    )
    told = told.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    asked = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.formatted_digests(asked.unionByName(told))


def op10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.nearest(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_decontaminate": op4_decontaminate,
    "op5_sharding": op5_sharding,
    "op6_lines": op6_lines,
    "op7_packing": op7_packing,
    "op8_tokenfile": op8_tokenfile,
    "op9_chat": op9_chat,
    "op10_pages": op10_pages,
    "op11_neighbours": op11_neighbours,
    "op12_collocations": op12_collocations,
    "op13_divergence": op13_divergence,
}
