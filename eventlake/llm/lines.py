"""Quality rules: figures of each text, and how often its lines occur elsewhere.

Normalised lines are hashed, and for each host (``source``) and line the distinct
documents are counted. Lines over the limit are removed; a document that loses too
much is rejected. Copies must not make each other's lines frequent, so the near copies of
a text (five-word Jaccard of 0.8 or more, see ``nearcopies``) count as one document. Lines
are counted by distinct texts first: there are never fewer of these, so only documents
with a line over the limit by that count are looked at for near copies. The limit grows with
the host, by its distinct texts, so that a verdict does not depend on how much of a host is
at hand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm import nearcopies
from eventlake.llm.hashfilter import filter_of, mostly_in
from eventlake.llm.shared import map_batches, stored, text_or_empty, word_blocks

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """What fails a document. A line is removed if it is in more than ``max_documents``
    and more than ``max_share`` of the distinct documents of its host, and has
    ``min_line_words`` words or more. ``min_left``: the share of its words that a document
    must keep. ``filter_bits``: size of a filter that is broadcast, as a power of two."""

    min_words: int = 10
    window: int = 5
    max_repeat_percent: int = 20
    max_documents: int = 20
    max_share: float = 0.04
    min_line_words: int = 3
    min_left: float = 0.3
    filter_bits: int = 26


def repeated_words(data: bytes, window: int) -> tuple[int, int]:
    """Words of a text, and those in windows that occur twice or more in it.

    Words become numbers, and windows numbers step by step from the pairs of a
    shorter window and its next word, so equal numbers mean equal windows.
    """
    ids: dict[bytes, int] = {}
    words = np.array(
        [ids.setdefault(w, len(ids)) for block in word_blocks(data) for w in block], dtype=np.int64
    )
    n = len(words) - window + 1
    if n < 2 or len(ids) == len(words):
        return len(words), 0
    code = words
    for step in range(1, window):
        code = code[: len(words) - step] * len(ids) + words[step:]
        if step < window - 1:
            code = np.unique(code, return_inverse=True)[1]
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    if not twice.any():
        return len(words), 0
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return len(words), int((np.cumsum(cover)[:-1] > 0).sum())


def normal(line: bytes) -> bytes:
    """Lower case, digits alike, one space between words."""
    return re.sub(rb"\d", b"0", b" ".join(line.decode(errors="replace").lower().encode().split()))


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(normal(line)) - (1 << 63)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _row(data: bytes, window: int, min_line_words: int) -> tuple:
    n_words, n_repeat = repeated_words(data, window)
    lines = [x for x in data.split(b"\n") if x.strip()]
    words: dict[int, int] = {}
    for x in lines:
        n = len(x.split())
        if n >= min_line_words:
            h = line_hash(x)
            words[h] = words.get(h, 0) + n
    return (
        n_words,
        sum(len(b"".join(block).decode()) for block in word_blocks(data)),
        sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))),
        len(lines) - len(set(lines)),
        n_repeat,
        list(words),
        list(words.values()),
    )


def _measure(window: int, min_line_words: int):
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                got = [_row(t.as_buffer().to_pybytes(), window, min_line_words) for t in part.column(4)]
                columns = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    ["doc_id", "source", "same", "node", *COUNTS, "line", "line_words"],
                )

    return run


def measured(docs: DataFrame, window: int = 5, min_line_words: int = 3) -> DataFrame:
    """The figures of each text and its lines by hash, without the text; shorter lines than
    ``min_line_words`` are not listed.

    ``same`` is a hash of source and text: with doc_id it names a row, and rows for
    which all three are equal get equal decisions. ``node`` is a hash of the text.
    """
    source = F.col("source").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.alias("source"),
        _same().alias("same"),
        nearcopies.node().alias("node"),
        text_or_empty().cast("binary").alias("text"),
    )
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return rows.transform(
        map_batches, _measure(window, min_line_words),
        f"doc_id long, source string, same long, node long, {counts}, line array<long>, line_words array<long>",
    )


def _same() -> Column:
    return F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("\0")), text_or_empty())


def _over_limit(held: DataFrame, hosts: DataFrame, limits: Limits) -> DataFrame:
    """(source, line, documents) over the limit; ``held``: distinct (source, line, document)."""
    by_line = held.groupBy("source", "line").agg(F.count(F.lit(1)).alias("documents"))
    by_line = by_line.filter(F.col("documents") > limits.max_documents)
    return by_line.join(hosts, F.col("source").eqNullSafe(F.col("host_"))).filter(
        F.col("documents") > limits.max_share * F.col("all_")
    ).select("source", "line", "documents")


def frequent_lines(rows: DataFrame, docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(source, line) of the lines over the limit, with their documents counted; ``rows``
    are the measured rows of ``docs``."""
    hosts = stored(
        rows.groupBy("source").agg(F.count_distinct("node").alias("all_")).select(F.col("source").alias("host_"), "all_"),
        "hosts",
    )
    lines = rows.select("source", "node", F.explode("line").alias("line"))
    often = stored(_over_limit(lines.distinct(), hosts, limits), "often").select(
        F.col("source").alias("often_source"), F.col("line").alias("often_line")
    )
    same = lines.source.eqNullSafe(often.often_source) & (lines.line == often.often_line)
    held = stored(lines.join(often, same, "left_semi").distinct(), "held")
    # Most texts hold no such line: a filter of fixed size keeps them out of the join.
    nodes = stored(held.select("node").distinct(), "holders")
    texts = docs.select(nearcopies.node().alias("node"), text_or_empty().cast("binary").alias("text"))
    few = mostly_in(texts, filter_of(nodes.select(F.col("node").alias("hash")), limits.filter_bits))
    roots = nearcopies.classes(stored(few.join(nodes, "node", "left_semi"), "held_texts"))
    return _over_limit(held.join(roots, "node").select("source", "line", "root").distinct(), hosts, limits)


def judged(rows: DataFrame, docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Adds ``removed`` (hashes of the lines to remove), ``n_left``, ``base_failed``
    and ``kept`` to measured rows."""
    lines = rows.select(
        "doc_id", "same", "source", F.explode(F.arrays_zip("line", "line_words")).alias("x")
    ).select("doc_id", "same", "source", "x.line", "x.line_words")
    often = stored(frequent_lines(rows, docs, limits), "frequent").select(
        F.col("source").alias("host_"), F.col("line").alias("often_")
    )
    hit = (
        lines.join(often, lines.source.eqNullSafe(often.host_) & (lines.line == often.often_))
        .groupBy("doc_id", "same", "line")
        .agg(F.first("line_words").alias("w"))
        .groupBy("doc_id", "same")
        .agg(F.sum("w").alias("lost"), F.collect_list("line").alias("removed"))
        .select(F.col("doc_id").alias("id_"), F.col("same").alias("same_"), "lost", "removed")
    )
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    return rows.join(hit, rows.doc_id.eqNullSafe(hit.id_) & (rows.same == hit.same_), "left").select(
        *rows.columns,
        F.coalesce("removed", F.array().cast("array<long>")).alias("removed"),
        left.alias("n_left"),
        failed.alias("base_failed"),
        (~failed & (left >= limits.min_left * F.col("n_words"))).alias("kept"),
    )


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: doc_id, figures, base_failed, kept, n_left.

    A null or empty text has no words and fails. A null source is a host of its own.
    Each row is a document; rows equal in doc_id, source and text are judged alike, and
    so are tied lines. An empty table gives no rows. Further columns are not looked at.
    """
    rows = stored(measured(docs, limits.window, limits.min_line_words), "quality")
    return judged(rows, docs, limits).select(
        "doc_id", *COUNTS, "base_failed", "kept", "n_left", F.size("removed").cast("long").alias("n_removed_lines")
    )


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops the last column, hashes of lines, and these lines from ``text``."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = []
        for text, hashes in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
            gone = set(hashes.as_py() or ())
            text = text.as_py()
            if gone:
                keep = (x for x in text.split("\n") if not x.encode().strip() or line_hash(x.encode()) not in gone)
                text = "\n".join(keep)
            texts.append(text)
        columns = batch.columns[:-1]
        columns[at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])


def clean(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that are kept, without their frequent lines; columns unchanged.

    ``n_chars``, where there is such a column, follows the text.
    """
    rows = stored(measured(docs, limits.window, limits.min_line_words), "quality")
    verdict = (
        judged(rows, docs, limits)
        .filter("kept")
        .groupBy("doc_id", "same")
        .agg(F.first("removed").alias("removed"))
        .select(F.col("doc_id").alias("id_"), F.col("same").alias("verdict_"), F.col("removed").alias("gone_"))
    )
    # Packed into a struct, the columns of the documents can have any names.
    whole = F.struct(*[docs[c] for c in docs.columns if c != "text"], F.col("text").cast("string").alias("text"))
    marked = docs.select(F.col("doc_id").alias("own_"), _same().alias("same_"), whole.alias("row_"))
    kept = marked.join(
        verdict, marked.own_.eqNullSafe(verdict.id_) & (marked.same_ == verdict.verdict_)
    ).select("row_.*", "gone_")
    done = kept.transform(map_batches, _rewrite, T.StructType(kept.schema.fields[:-1])).select(*docs.columns)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done
