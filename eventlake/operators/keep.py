"""Row selection shared by the layers: duplicates, counting and ranking."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Keeps a bounded input for several actions and releases it afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def one_row_per(
    df: DataFrame, keys: Sequence[str], lowest: Sequence[str] = ()
) -> DataFrame:
    """One whole row for each combination of keys, NULL keys being equal.

    Like ``dropDuplicates(keys)``, but the survivor is the smallest row, ordered by
    ``lowest`` (NULL last) and then by the other columns, so a re-run keeps the same
    one. It is an aggregate: copies collapse inside each map task before the shuffle,
    and a key with very many copies sends one row per task. Select the columns you
    need first: the survivor is compared as one struct and is not pruned.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [o for c in lowest for o in (F.col(c).isNull(), F.col(c))]
    ranked = F.struct(
        *(o.alias(f"order{i}") for i, o in enumerate(order)),
        F.struct(*rest).alias("row"),
    )
    kept = df.groupBy(*keys).agg(F.min(ranked).alias("kept"))
    return kept.select(
        *(c if c in keys else F.col(f"kept.row.{c}").alias(c) for c in df.columns)
    )


def count_by(df: DataFrame, *keys: str | Column, name: str = "event_count") -> DataFrame:
    """Rows per key, NULL being a key of its own. Counts partially before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The n rows with the largest measure; equal measures go by ``ties`` ascending.

    Runs as a per-task top n that is merged once: n rows per task move, and nothing
    is sorted as a whole.
    """
    return df.orderBy(F.desc(measure), *(F.asc(t) for t in ties)).limit(n)
