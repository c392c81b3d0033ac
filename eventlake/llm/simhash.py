"""SimHash near-duplicates: fingerprints, exact links, components.

Every pair of fingerprints within the radius is found. Fingerprints are cut into
``radius + 2`` blocks of bits; two that differ in at most ``radius`` bits agree in at
least two blocks, so they meet under one of the pairs of blocks. Rows that meet are
compared bit-sliced. Equal fingerprints are one node, so copies cost nothing here.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.shared import map_batches, share_code, stored, text_or_empty, word_blocks

BITS = 64
_FULL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
# For each byte value, its bits from the highest.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANE = np.arange(8, dtype=np.uint16) * 256


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash over the word shingles of a text, repeats included.

    A-Z count as a-z. Fewer words than a shingle: the whole sequence is one shingle.
    No word: 0. A bit is set if it is in more than half of the shingle hashes.
    """
    counts = np.zeros(2048, dtype=np.int64)
    total, carried = 0, []
    digest = xxhash.xxh64_digest
    for block in word_blocks(text.lower()):
        block = carried + block
        shingles = zip(*(block[i:] for i in range(words)), strict=False)
        got = b"".join([digest(b" ".join(s), seed) for s in shingles])
        if got:
            lanes = np.frombuffer(got, dtype=np.uint8).reshape(-1, 8) + _LANE
            counts += np.bincount(lanes.ravel(), minlength=2048)
            total += len(lanes)
        carried = block[max(0, len(block) - words + 1) :]
    if not total:
        if not carried:
            return 0
        return int.from_bytes(digest(b" ".join(carried), seed), "big", signed=True)
    ones = np.einsum("jv,vb->jb", counts.reshape(8, 256), _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(bytes(t)) for t in texts], dtype="int64")


def with_fingerprints(docs: DataFrame, column: str = "fingerprint_") -> DataFrame:
    """Adds the fingerprint of ``text`` as a signed long; a null text counts as empty."""
    share_code(docs.sparkSession)
    return docs.withColumn(column, _fingerprints(text_or_empty().cast("binary")))


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a word."""
    padded = np.zeros(-(-len(fps) // 64) * 64, dtype=np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near(fps: np.ndarray, radius: int, stride: int = 8) -> Iterator[tuple[int, np.ndarray]]:
    """For each fingerprint with others within ``radius``: its place, and a bit row
    that marks itself and them.

    Distances of one fingerprint to all others grow together in bitwise counters: two
    planes of differences enter a carry-save adder, carries ripple up, and what leaves
    the top counter marks a distance as too large. Every ``stride`` planes the rows in
    which all other distances are too large are given up.
    """
    up = planes(fps)
    levels = max(1, radius.bit_length())
    pad = np.zeros(up.shape[1], dtype=np.uint64)
    if len(fps) % 64:
        pad[-1] = _FULL << np.uint64(len(fps) % 64)
    for start in range(0, len(fps), 512):
        rows = np.arange(start, min(start + 512, len(fps)))
        own = np.zeros((len(rows), up.shape[1]), dtype=np.uint64)
        own[np.arange(len(rows)), rows // 64] = np.uint64(1) << (rows % 64).astype(np.uint64)
        over = np.repeat(pad[None, :], len(rows), axis=0)
        counter = [np.zeros_like(over) for _ in range(levels)]
        for b in range(0, BITS, 2):
            flip = [
                np.where((fps[rows] >> np.uint64(x)) & np.uint64(1), _FULL, np.uint64(0))
                for x in (b, b + 1)
            ]
            one, two = up[b] ^ flip[0][:, None], up[b + 1] ^ flip[1][:, None]
            half = counter[0] ^ one
            carry = (counter[0] & one) | (half & two)
            counter[0] = half ^ two
            for k in range(1, levels):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
            if (b + 2) % stride == 0:
                alive = ((over | own) != _FULL).any(axis=1)
                if not alive.all():
                    rows, own, over = rows[alive], own[alive], over[alive]
                    counter = [c[alive] for c in counter]
                if not len(rows):
                    break
        if len(rows):
            over |= _more_than(counter, radius)
            for i in np.flatnonzero(((over | own) != _FULL).any(axis=1)):
                yield int(rows[i]), ~over[i]


def _more_than(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Marks counters over the radius, where it is not the largest they can hold."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], _FULL)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            same &= counter[k]
        else:
            more |= same & counter[k]
            same &= ~counter[k]
    return more


def _stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected within ``fps``: each to its smallest."""
    links = dict(near(fps, radius))
    left = np.zeros(-(-len(fps) // 64) or 1, dtype=np.uint64)
    for i in links:
        left[i // 64] |= np.uint64(1) << np.uint64(i % 64)
    signed = fps.view(np.int64)
    members, roots = [], []
    for i in links:
        if not left[i // 64] >> np.uint64(i % 64) & np.uint64(1):
            continue
        found, todo = [], [i]
        left[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        while todo:
            at = todo.pop()
            found.append(at)
            fresh = links[at] & left
            left &= ~fresh
            bits = np.unpackbits(fresh.view(np.uint8), bitorder="little")
            todo.extend(np.flatnonzero(bits).tolist())
        group = signed[found]
        root = group.min()
        members.append(group[group != root])
        roots.append(np.full(len(members[-1]), root))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([*members, none]), np.concatenate([*roots, none])


def _compare(radius: int, most: int):
    """Compares rows that come sorted by key, whole keys at a time, about ``most`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64)

        def out(n: int) -> pa.RecordBatch:
            a, b = _stars(np.unique(fps[:n]).view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            keys = np.concatenate([keys, key])
            fps = np.concatenate([fps, batch.column(3).to_numpy()])
            while len(fps) > most:
                ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                # As many whole keys as fit, or else the first key.
                fit = ends[ends <= most]
                n = int(fit[-1]) if len(fit) else int(ends[0]) if len(ends) else 0
                if not n:
                    break
                yield out(n)
                keys, fps = keys[n:], fps[n:]
        if len(fps):
            yield out(len(fps))

    return run


def block_masks(blocks: int) -> list[int]:
    """For each pair of blocks, the mask of their bits as a signed long."""
    cuts = [round(BITS * i / blocks) for i in range(blocks + 1)]
    bits = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    masks = [a | b for a, b in combinations(bits, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, radius: int = 3, chunk: int = 2048) -> DataFrame:
    """Links (a, b), b < a, that connect exactly what lies within ``radius`` of each
    other; ``nodes`` holds distinct fingerprints in ``fp``.

    Keys that only one fingerprint has are dropped before anything is compared. The
    rows of a key that has more than ``chunk`` are dealt into chunks by hash, and each
    pair of chunks is compared in a group of its own, so no key sits in one task. A
    group returns a spanning forest, not its pairs.
    """
    masks = block_masks(radius + 2)
    keyed = nodes.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"),
    )
    met = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("long")
    own = F.pmod(F.xxhash64("fp"), chunks)
    other = F.sequence(F.lit(0).cast("long"), chunks - 1)
    pairs = F.when(chunks == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.filter(other, lambda x: x != own),
            lambda x: F.least(own, x) * chunks + F.greatest(own, x),
        )
    )
    dealt = keyed.join(met, ["t", "key"]).select(
        F.col("t").cast("long").alias("t"), "key", F.explode(pairs).alias("pair"), "fp"
    )
    groups = dealt.repartition("t", "key", "pair").sortWithinPartitions("t", "key", "pair", "fp")
    return groups.transform(map_batches, _compare(radius, 2 * chunk), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root): the smallest node of its component, for each node that has an edge.

    Large-star and small-star steps in turn until nothing changes. Each round is
    written to the shared folder, which keeps the lineage short.
    """
    state, before = stored(edges, "edges"), None
    while True:
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = stored(moved.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = state.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if now == before:
            return state.select("a", F.col("b").alias("root"))
        before = now


def classes(rows: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, root, component_id) for each fingerprint in ``rows`` (doc_id, fp)."""
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    roots = components(links(nodes.select("fp"), radius))
    member = nodes.join(roots, nodes.fp == roots.a, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    return member.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included. Null or empty texts have fingerprint zero and link like any other. A null
    doc_id never names a component unless the component has no other; rows that share
    a doc_id are told apart by their fingerprints. Further columns are not looked at.
    An empty table gives no rows.
    """
    rows = stored(
        with_fingerprints(docs.select("doc_id", "text")).select(
            "doc_id", F.col("fingerprint_").alias("fp")
        ),
        "simhash",
    )
    return rows.join(classes(rows, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """Keeps one row of each component, that with the smallest doc_id, columns unchanged.

    Rows that share doc_id and fingerprint count as one document. In a component
    whose doc_ids are all null, one row stays.
    """
    # Packed into a struct, the columns of the documents can have any names.
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row_"), "doc_id", "text")
    # Fingerprints are made once and stored beside the rows: the last join reads them
    # instead of sending every whole row through Python a second time.
    marked = stored(
        with_fingerprints(packed).select(
            F.col("doc_id").isNull().alias("null_"),
            F.coalesce("doc_id", F.lit(0)).cast("long").alias("id_"),
            "fingerprint_",
            "doc_id",
            "row_",
        ),
        "simhash",
    )
    rows = marked.select("doc_id", F.col("fingerprint_").alias("fp"))
    keep = (
        rows.join(classes(rows, radius), "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("component_id").alias("doc_id"), F.min("fp").alias("fingerprint_"))
        .select(
            F.col("doc_id").isNull().alias("null_"),
            F.coalesce("doc_id", F.lit(0)).cast("long").alias("id_"),
            "fingerprint_",
        )
    )
    key = ["null_", "id_", "fingerprint_"]
    kept = marked.select(*key, "row_").join(keep, key, "left_semi").dropDuplicates(key)
    return kept.select("row_.*")
