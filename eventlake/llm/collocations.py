"""Collocations by dynamic itemset counting over shards of the corpus.

The texts are dealt into shards once, and rounds scan one shard after another, in a
circle. Words are counted from the first round on. A longer phrase becomes active as
soon as both phrases it has one word more than (its first and its last words) have
reached the threshold, which may be in the middle of a circle, and is counted for one
full circle from there. So lengths interleave, and a phrase is never counted before both
its parts are known to be frequent.

A round needs to know which parts have reached the threshold. Tasks get that as two Bloom
filters of fixed size, whatever the corpus: they let through every active phrase, and a
few others, which a join with the exact table then removes.

Almost all pairs of frequent words are rare. So during the first circle all pairs are
also counted by hash, in a fixed number of buckets, and a pair is active only once its
bucket has reached the threshold too. A bucket never holds less than any of its pairs, so
no frequent pair is lost; it only keeps rare ones out of the exact counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.hashfilter import HashFilter, filter_of, probes
from eventlake.llm.shared import map_batches, share_code, stored, text_or_empty
from eventlake.llm.words import blocks, byte_classes, gathered, split_words
from eventlake.sources.scratch import file_store, scratch_path

# White space between words, and what ends a piece.
CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``filter_bits``, ``bucket_bits``: size of a Bloom filter, and number of buckets, as
    powers of two. They bound what is broadcast (two filters, two bits a bucket) and what a
    task holds (a byte a bucket); if the corpus has more than they can tell apart, more
    rows are shuffled, and the result is the same."""

    threshold: int = 30
    max_words: int = 4
    shards: int = 3
    contained_percent: int = 80
    first: int = 2000
    filter_bits: int = 26
    bucket_bits: int = 24
    block: int = 4 << 20


def word_hashes(names: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(n, seed) for n in names], dtype=np.uint64)


def glued(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases that go on with a word."""
    return (phrase ^ (phrase >> np.uint64(31))) * _MIX + word


class Buckets:
    """For each bucket the round in which it reached the threshold; ``never`` before that."""

    NEVER = 255

    def __init__(self, bits: int):
        self.bits, self.rounds = bits, None

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return probes(hashes, self.bits)[0]

    def reached(self, t: int, bitmaps: dict[int, bytes]) -> None:
        """Notes all buckets that have reached the threshold by round ``t``."""
        if self.rounds is None:
            self.rounds = np.full(1 << self.bits, self.NEVER, dtype=np.uint8)
        for block, bits in bitmaps.items():
            part = self.rounds[block * BLOCK : (block + 1) * BLOCK]
            now = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(part)).astype(bool)
            part[now & (part == self.NEVER)] = t

    def __getstate__(self):
        return self.bits, None if self.rounds is None else zlib.compress(self.rounds, 1)

    def __setstate__(self, state):
        self.bits = state[0]
        self.rounds = None if state[1] is None else np.frombuffer(zlib.decompress(state[1]), np.uint8)

    def since(self, hashes: np.ndarray) -> np.ndarray:
        if self.rounds is None:
            return np.full(len(hashes), self.NEVER, dtype=np.uint8)
        return self.rounds[self.of(hashes)]


#: Buckets that are sent and added up together.
BLOCK = 4096


def _bucket_task(settings: Settings):
    """Counts of all pairs by bucket, as blocks of bytes that stop at 255."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(settings.bucket_bits)
        counts = np.zeros(1 << settings.bucket_bits, dtype=np.uint8)

        def work(key: tuple, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            whole = b"\n".join(texts).lower()
            for data, limit in blocks(whole, 2 * settings.block, CLASSES, 1):
                w = split_words(data, CLASSES)
                both = (w.piece[1:] == w.piece[:-1]) & (w.starts[:-1] < limit)
                by_word = word_hashes(w.names.to_pylist(), key[0])[w.ids]
                at, n = np.unique(buckets.of(glued(by_word[:-1], by_word[1:])[both]), return_counts=True)
                counts[at] = np.minimum(counts[at] + n, 255)
            yield from ()

        yield from gathered(batches, settings.block, work)
        for block, part in enumerate(counts.reshape(-1, min(BLOCK, len(counts)))):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()])], ["block", "counts"])

    return run


def _add_blocks(threshold: int):
    """The sum of one block's counts, and a bit for each bucket that has the threshold."""

    def run(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.uint8).astype(np.int64) for c in rows.column("counts"))
        total = np.minimum(total, 255).astype(np.uint8)
        full = np.packbits(total >= min(threshold, 255)).tobytes()
        return pa.table([rows.column("block")[:1], pa.array([total.tobytes()]), pa.array([full])], ["block", "counts", "full"])

    return run


def _counted(data: bytes, limit: int, lang: str, words_too: bool, t: int, known, fresh, buckets, settings: Settings):
    """(length, phrases, counts, rounds of their buckets) of the active phrases that
    begin before ``limit``."""
    longest = settings.max_words
    w = split_words(data, CLASSES)
    n = len(w.ids)
    if not n:
        return
    begins = w.starts < limit
    if words_too:
        count = np.bincount(w.ids[begins], minlength=len(w.names))
        at = np.flatnonzero(count)
        yield 1, w.names.take(pa.array(at)), count[at], None
    if not known.parts:
        return
    by_word = word_hashes(w.names.to_pylist(), lang)
    hashes = by_word[w.ids]
    # Of the phrase of each length that begins at each word: is it known, is it fresh?
    is_known, is_fresh = known.has(by_word)[w.ids], fresh.has(by_word)[w.ids]
    for length in range(2, longest + 1):
        m = n - length + 1
        if m <= 0:
            return
        whole = is_known[:m] & is_known[1 : m + 1] & (w.piece[:m] == w.piece[length - 1 :])
        new = is_fresh[:m] | is_fresh[1 : m + 1]
        hashes = glued(hashes[:m], by_word[w.ids[length - 1 :]])
        if length == 2:
            since = buckets.since(hashes)
            whole &= since < t
            new |= since >= t - min(t, settings.shards)
        at = np.flatnonzero(whole & new & begins[:m])
        if len(at):
            code = w.ids[at]
            for k in range(1, length):
                code = code * len(w.names) + w.ids[at + k]
                if k < length - 1:
                    code = np.unique(code, return_inverse=True)[1]
            _, first, count = np.unique(code, return_index=True, return_counts=True)
            parts = [w.names.take(pa.array(w.ids[at[first] + k])) for k in range(length)]
            yield length, pc.binary_join_element_wise(*parts, b" "), count, since[at[first]] if length == 2 else None
        if length < longest:
            here = np.flatnonzero(whole)
            is_known, is_fresh = np.zeros(m, dtype=bool), np.zeros(m, dtype=bool)
            is_known[here] = known.has(hashes[here])
            is_fresh[here] = fresh.has(hashes[here])
            if not is_known.any():
                return


def _count_task(filters, words_too: bool, t: int, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, fresh, buckets = filters.value

        def work(key: tuple, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            # The line end between two texts ends a piece.
            whole = b"\n".join(texts).lower()
            for data, limit in blocks(whole, 2 * settings.block, CLASSES, settings.max_words - 1):
                got = _counted(data, limit, key[0], words_too, t, known, fresh, buckets, settings)
                for length, phrases, count, since in got:
                    columns = [
                        pa.repeat(pa.scalar(key[0], pa.string()), len(count)),
                        phrases.cast(pa.string()),
                        pa.repeat(pa.scalar(length, pa.int32()), len(count)),
                        pa.array(count, pa.int64()),
                        pa.nulls(len(count), pa.int32()) if since is None else pa.array(since, pa.int32()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "len", "n", "since"])

        yield from gathered(batches, settings.block, work)

    return run


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")), strict=True)
        for lang, phrase in rows:
            by_word = word_hashes(phrase.encode().split(b" "), lang)
            h = by_word[:1]
            for k in range(1, len(by_word)):
                h = glued(h, by_word[k : k + 1])
            hashes.append(h)
        found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["hash"])


def _filter_of(phrases: DataFrame, bits: int) -> HashFilter:
    hashes = phrases.select("lang", "phrase").transform(map_batches, _hash_task, "hash long")
    return filter_of(hashes, bits)


def _first(words: Column | int) -> Column:
    return F.expr(f"substring_index(phrase, ' ', {words})")


@dataclass(frozen=True)
class Counts:
    """``phrases`` (lang, phrase, len, n): every phrase that occurs as often as the
    threshold. ``totals`` (lang, words): all word occurrences."""

    phrases: DataFrame
    totals: DataFrame


def frequent_phrases(docs: DataFrame, settings: Settings = Settings()) -> Counts:
    """Counts phrases of ``docs`` (lang, text) until each has seen one full circle."""
    spark, shards = docs.sparkSession, settings.shards
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        text_or_empty().cast("binary").alias("text"),
    )
    # Dealt in turn, so that copies spread; fixed by being written.
    dealt = scratch_path(spark, "shards")
    dealt_rows = texts.filter(F.length("text") > 0).withColumn("shard", F.monotonically_increasing_id() % shards)
    dealt_rows.write.partitionBy("shard").option("compression", "zstd").parquet(dealt)
    root, store = file_store(spark, dealt)
    empty = HashFilter(settings.filter_bits, {})
    # Of each round: what reached the threshold in it. Older than a circle: all in one.
    by_round: list[HashFilter] = []
    older = empty
    done_paths: list[str] = []
    buckets = Buckets(settings.bucket_bits)
    open_path, sums, last, t = None, None, None, 0
    totals = _rows(spark, "lang string, words long", [])
    # The last pairs begin when their buckets are complete, longer phrases after their parts.
    while t < shards or (last is not None and t <= max(last, shards - 1) + shards):
        state = _rows(spark, STATE, [open_path] if open_path else [])
        complete = _rows(spark, STATE, done_paths)
        reached = state.unionByName(complete).filter(F.col("reach").isNotNull() & (F.col("len") < settings.max_words))
        if t:
            by_round.append(_filter_of(reached.filter(F.col("reach") == t - 1), settings.filter_bits))
        if len(by_round) > shards:
            older |= by_round.pop(0)
        # Fresh: a phrase made of it may still have shards to see.
        fresh = reduce(or_, by_round, empty)
        filters = spark.sparkContext.broadcast((older | fresh, fresh, buckets))
        shard = _rows(spark, "lang string, text binary", [f"{dealt}/shard={t % shards}"])
        seen = shard.transform(
            map_batches, _count_task(filters, t < shards, t, settings),
            "lang string, phrase string, len int, n long, since int",
        )
        none = F.lit(None).cast("int")
        now_path = scratch_path(spark, "now")
        (
            state.withColumn("since", none)
            .unionByName(seen.withColumns({"start": none, "reach": none}))
            .groupBy("lang", "phrase")
            .agg(*(F.max(c).alias(c) for c in ("len", "start", "reach", "since")), F.sum("n").alias("n"))
            .withColumn("start", F.when(F.col("len") == 1, F.lit(0)).otherwise(F.col("start")))
            .write.parquet(now_path)
        )
        # Written, so that the shard is scanned once.
        now = _rows(spark, f"{STATE}, since int", [now_path])
        counted = now.filter(F.col("start").isNotNull()).drop("since")
        if t:
            counted = counted.unionByName(_started(now.filter(F.col("start").isNull()), reached, t, shards))
        if t < shards:
            added = _rows(spark, "block int, counts binary", [sums] if sums else []).unionByName(
                shard.transform(map_batches, _bucket_task(settings), "block int, counts binary")
            )
            share_code(spark)
            sums = scratch_path(spark, "buckets")
            added.groupBy("block").applyInArrow(
                _add_blocks(settings.threshold), "block int, counts binary, full binary"
            ).write.parquet(sums)
            # A bit for each bucket.
            buckets.reached(t, {r.block: bytes(r.full) for r in _rows(spark, "block int, full binary", [sums]).collect()})
        counted = counted.withColumn(
            "reach", F.coalesce("reach", F.when(F.col("n") >= settings.threshold, F.lit(t).cast("int")))
        ).withColumn("done", F.col("start") + shards <= t + 1)
        if t == shards - 1:
            # Words are complete after this round; the rare ones count for the totals only.
            counted = stored(counted, "words")
            totals = stored(counted.filter("len = 1").groupBy("lang").agg(F.sum("n").alias("words")), "totals")
        watch, path = Observation(), scratch_path(spark, "phrases")
        (
            counted.filter(~F.col("done") | (F.col("n") >= settings.threshold))
            .observe(watch, F.max(F.when(F.col("len") < settings.max_words, F.col("reach"))).alias("last"))
            .write.partitionBy("done")
            .parquet(path)
        )
        found = [r for r in (last, watch.get["last"]) if r is not None]
        last = max(found, default=None)
        if open_path:
            store.delete(file_store(spark, open_path)[0], True)
        open_path = f"{path}/done=false"
        done_paths.append(f"{path}/done=true")
        store.delete(file_store(spark, now_path)[0], True)
        filters.unpersist()
        t += 1
    store.delete(root, True)
    return Counts(_rows(spark, STATE, done_paths).select("lang", "phrase", "len", "n"), totals)


#: Phrases under way: round of the first count, count so far, round that reached the threshold.
STATE = "lang string, phrase string, len int, start int, n long, reach int"


def _rows(spark: SparkSession, schema: str, paths: list[str]) -> DataFrame:
    """What lies at these paths; none need to be there."""
    there = [p for p in paths if (where := file_store(spark, p))[1].exists(where[0])]
    if there:
        return spark.read.schema(schema).parquet(*there)
    fields = spark.createDataFrame([], schema).schema
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))


def _started(rows: DataFrame, reached: DataFrame, t: int, shards: int) -> DataFrame:
    """Of phrases met for the first time those that are active, with the round they
    became so: the one after both their parts, and the bucket of a pair, reached the
    threshold."""
    def part(side: str) -> DataFrame:
        names = {"lang": f"{side}_lang", "phrase": f"{side}_phrase", "reach": f"{side}_reach"}
        return reached.select(*(F.col(c).alias(n) for c, n in names.items()))

    head, tail = part("head"), part("tail")
    both = rows.withColumns({"head": _first("len - 1"), "tail": _first("1 - len")})
    both = both.join(head, (F.col("lang") == F.col("head_lang")) & (F.col("head") == F.col("head_phrase")))
    both = both.join(tail, (F.col("lang") == F.col("tail_lang")) & (F.col("tail") == F.col("tail_phrase")))
    start = (F.greatest("head_reach", "tail_reach", "since") + 1).cast("int")
    return both.withColumn("start", start).filter(F.col("start") + shards > t).drop("since").select(
        *(c for c in rows.columns if c != "since")
    )


def _exact(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with their lowest-scoring cut: a, l, r, score.

    All parts of a frequent phrase are frequent, so each is in ``phrases``.
    """
    long = phrases.filter("len > 1").withColumnRenamed("n", "a")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("len") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.call_function("substring_index", F.col("phrase"), F.lit(" "), k).alias("head"),
            F.call_function("substring_index", F.col("phrase"), F.lit(" "), k - F.col("len")).alias("tail"),
        ),
    )
    cut = long.select("lang", "phrase", "len", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "len", "a", "c.*")
    left = phrases.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("phrase_l"), F.col("n").alias("l"))
    right = phrases.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("phrase_r"), F.col("n").alias("r"))
    cut = cut.join(left, (F.col("lang") == F.col("lang_l")) & (F.col("head") == F.col("phrase_l")))
    cut = cut.join(right, (F.col("lang") == F.col("lang_r")) & (F.col("tail") == F.col("phrase_r")))
    # div of decimals rounds down here, since nothing is negative.
    cut = cut.withColumns({"num": _exact(F.lit(2_000_000)) * _exact(F.col("a")), "den": _exact(F.col("l")) + _exact(F.col("r"))})
    cut = cut.withColumn("score", F.expr("num div den").cast("long"))
    best = cut.groupBy("lang", "phrase", "len", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "len", "a", "c.l", "c.r", "c.score")


def not_contained(rows: DataFrame, percent: int) -> DataFrame:
    """Without phrases that lie inside a longer one that is ``percent`` as frequent."""
    inner = F.expr(
        """flatten(transform(sequence(2, len - 1), m -> transform(sequence(0, len - m), i ->
             array_join(slice(split(phrase, ' '), i + 1, m), ' '))))"""
    )
    longer = (
        rows.filter("len > 2")
        .select(F.col("lang").alias("in_lang"), F.explode(F.array_distinct(inner)).alias("in_phrase"), "a")
        .groupBy("in_lang", "in_phrase")
        .agg(F.max("a").alias("longer"))
    )
    same = (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("in_phrase"))
    inside = _exact(F.col("longer")) * 100 >= _exact(F.col("a")) * percent
    return rows.join(longer, same, "left").filter(~F.coalesce(inside, F.lit(False))).select(*rows.columns)


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null language is ``und``; a null or empty text has no words. Each row is a text, so
    repeated rows count as often as they occur. Texts of any length are read whole, in
    blocks. Equal scores go by count, then by phrase in byte order. An empty table, and one
    without frequent phrases, gives no rows. Further columns are not looked at.
    """
    counts = frequent_phrases(docs, settings)
    rows = not_contained(scored(stored(counts.phrases, "frequent")), settings.contained_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First in parts of each language: a task ranks a part, then the firsts of all parts.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    firsts = rows.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= settings.first)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= settings.first).withColumnRenamed("lang", "of")
    return ranked.join(counts.totals, F.col("of") == F.col("lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score"
    )
