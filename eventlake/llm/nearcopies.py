"""Near copies: texts whose sets of five-word shingles have Jaccard similarity 0.8 or more.

Each text gets ``BANDS`` keys of ``ROWS`` MinHash values. Texts that meet under a key, directly
or over others, are a cluster; inside a cluster whole shingle sets are compared, so a link
is always exact. Two texts of similarity s miss each other's cluster with chance
(1 - s ** ROWS) ** BANDS at most: 8e-5 at 0.8, 2e-8 at 0.9. Equal texts are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import map_batches, stored, text_or_empty, word_blocks
from eventlake.llm.simhash import components

WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 7, 40

_RNG = np.random.default_rng(42)
_XOR, _FACTOR = (_RNG.integers(0, 1 << 64, (ROWS * BANDS, 1), dtype=np.uint64) for _ in range(2))
_FACTOR |= np.uint64(1)
_MIX = _RNG.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct word shingles. A-Z count as a-z. Fewer words than a
    shingle: the whole sequence is one."""
    found, carried = [], []
    for block in word_blocks(data.lower()):
        block = carried + block
        parts = zip(*(block[i:] for i in range(words)), strict=False)
        got = b"".join([xxhash.xxh64_digest(b" ".join(s)) for s in parts])
        found.append(np.unique(np.frombuffer(got, dtype=np.uint64)))
        carried = block[max(0, len(block) - words + 1) :]
    if not any(map(len, found)):
        return np.array([xxhash.xxh64_intdigest(b" ".join(carried))], dtype=np.uint64)
    return np.unique(np.concatenate(found))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band, equal where all MinHash values of the band are."""
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 1024):
        low = np.minimum(low, ((hashes[i : i + 1024] ^ _XOR) * _FACTOR).min(axis=1))
    return ((low.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    if small < SIMILARITY * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILARITY * (len(a) + len(b) - both)


def node() -> Column:
    return F.xxhash64(text_or_empty())


def _key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [band_keys(shingles(t.as_buffer().to_pybytes())) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"]
        )


class Rest:
    """Texts of a cluster that are unlike its first one, against further texts of it."""

    def __init__(self):
        self.nodes: list[int] = []
        self.keys: list[np.ndarray] = []
        self.sets: list[np.ndarray] = []
        self.label: np.ndarray | None = None

    def hold(self, node: int, keys: np.ndarray, text: bytes) -> None:
        self.nodes.append(node)
        self.keys.append(keys)
        self.sets.append(shingles(text))

    def links(self, node: int, keys: np.ndarray, text: bytes, to_first: bool) -> Iterator[tuple[int, int]]:
        """Links of one text that join what is not joined yet. ``to_first``: it is known to
        be like the first text, as are all texts with label -1."""
        if self.label is None:
            self.label = np.arange(len(self.nodes))
            self.key_table = np.array(self.keys)
        own, here = -1 if to_first else None, None
        for j in np.flatnonzero((self.key_table == keys).any(axis=1)):
            if self.nodes[j] == node or (own is not None and self.label[j] == own):
                continue
            here = shingles(text) if here is None else here
            if similar(here, self.sets[j]):
                yield max(node, self.nodes[j]), min(node, self.nodes[j])
                if own is None:
                    own = self.label[j]
                else:
                    low, high = sorted((own, self.label[j]))
                    self.label[self.label == high] = low
                    own = low


def _rest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the texts to hold of each (root, chunk, part) with the others, which follow."""
    group, rest = None, Rest()
    for batch in batches:
        links = []
        names = ("root", "chunk", "part", "follows", "to_first", "node")
        heads = zip(*(batch.column(k).to_pylist() for k in names), strict=True)
        for i, (*of, follows, to_first, name) in enumerate(heads):
            if group != of:
                group, rest = of, Rest()
            keys = batch.column("keys")[i].values.to_numpy()
            text = batch.column("text")[i].as_buffer().to_pybytes()
            if follows:
                links += rest.links(name, keys, text, to_first)
            else:
                rest.hold(name, keys, text)
        columns = list(zip(*links, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _first_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the rows of each (root, part) with the first of them, the root's own text."""
    group, first = None, None
    for batch in batches:
        links = []
        heads = zip(*(batch.column(k).to_pylist() for k in ("root", "part", "node")), strict=True)
        for i, (root, part, name) in enumerate(heads):
            here = shingles(batch.column("text")[i].as_buffer().to_pybytes())
            if group != (root, part):
                group, first = (root, part), here
            elif similar(first, here):
                links.append((name, root))
        columns = list(zip(*links, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def links(texts: DataFrame, nodes: DataFrame, chunk: int = 512) -> DataFrame:
    """Links (a, b), b < a, between similar texts; ``nodes`` holds (node, keys).

    Texts that share a key, directly or over others, are a cluster. Each of its texts is
    first compared with that of its smallest node, in parts of ``chunk`` rows: a group
    of copies is done with that. What is unlike it, mostly few, is dealt into chunks,
    and each chunk is compared with each part of the cluster, so no cluster sits in
    one task. What is connected already is not compared again.
    """
    zero = F.lit(0).cast("long")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    edges = keyed.join(met.select("key", "b"), "key").filter("node > b").select(F.col("node").alias("a"), "b")
    linked = stored(components(edges.distinct()), "clusters")
    whole = texts.dropDuplicates(["node"])

    def parts(n: str) -> Column:
        return F.ceil(F.col(n) / chunk).cast("long")

    sizes = linked.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    in_part = F.pmod(F.xxhash64("node"), parts("n")).alias("part")
    member = linked.select(F.col("a").alias("node"), "root").join(sizes, "root")
    first = sizes.select(F.col("root").alias("node"), "root", F.explode(F.sequence(zero, parts("n") - 1)).alias("part"))
    rows = whole.join(member.select("node", "root", in_part).unionByName(first), "node").select("root", "part", "node", "text")
    # The root is the smallest node of its cluster, so it comes first.
    rows = rows.repartition("root", "part").sortWithinPartitions("root", "part", "node")
    like_first = stored(rows.transform(map_batches, _first_task, "a long, b long"), "links")

    rest = stored(linked.join(like_first, "a", "left_anti").select(F.col("a").alias("node"), "root"), "rest")
    left = rest.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    both = member.join(left, "root").join(rest.select("node", F.lit(False).alias("to_first")), "node", "left")
    told = both.select(
        "node", "root", F.explode(F.sequence(zero, parts("m") - 1)).alias("chunk"), in_part,
        F.lit(True).alias("follows"), F.coalesce("to_first", F.lit(True)).alias("to_first"),
    )
    held = rest.join(left, "root").join(sizes, "root").select(
        "node", "root", F.pmod(F.xxhash64("node"), parts("m")).alias("chunk"),
        F.explode(F.sequence(zero, parts("n") - 1)).alias("part"), F.lit(False).alias("follows"), F.lit(False).alias("to_first"),
    )
    groups = whole.join(told.unionByName(held), "node").join(nodes, "node")
    group = ["root", "chunk", "part"]
    groups = groups.repartition(*group).sortWithinPartitions(*group, "follows", "node")
    return like_first.unionByName(groups.transform(map_batches, _rest_task, "a long, b long").distinct())


def classes(texts: DataFrame) -> DataFrame:
    """(node, root) for each ``node`` of ``texts`` (node, text as bytes); near copies, and
    what they connect, share a root. Equal nodes are taken for equal texts."""
    keyed = texts.transform(map_batches, _key_task, "node long, keys array<long>")
    nodes = stored(keyed.groupBy("node").agg(F.first("keys").alias("keys")), "nodes")
    roots = components(links(texts, nodes))
    return nodes.join(roots, nodes.node == roots.a, "left").select("node", F.coalesce("root", "node").alias("root"))
