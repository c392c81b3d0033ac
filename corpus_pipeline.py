"""From raw documents to packed training sequences, as stages that run one by one.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but
the last return the columns of ``documents``, whatever further columns there are and whatever
their names. Each takes an empty table, null columns, and texts of any length whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import decontaminate, lines, packing, secrets, simhash
from eventlake.llm.shared import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines leave the others.

    A null or empty text has too few words and goes. Repeated rows are judged alike, as are
    tied lines; a null source is a host of its own.
    """
    return lines.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: SimHash of three-word shingles, linked within three bits.

    The row with the smallest doc_id stays; a null one only where no row has an id. Rows that
    share doc_id and fingerprint are one. Texts without words are one group.
    """
    return simhash.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    A null or empty text holds none. Repeated rows are judged alike; a null or empty item,
    or a repeated one, changes nothing.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; every document stays.

    A null text stays null. Repeated rows each stay and lose the same spans; where spans
    overlap, what they cover together goes.
    """
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of sequences of bounded length.

    A null or empty text is its end identifier alone. Repeated rows are documents of their
    own, a null doc_id included.
    """
    return packing.packed(docs, packing.public_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("pack", pack),
]

#: SQL has no xxHash, edit distance or tokenizer; tests hold each stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
