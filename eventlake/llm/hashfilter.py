"""A Bloom filter over 64-bit hashes, of a size that does not grow with the data.

It is broadcast to keep out of a shuffle most of what a join would drop; the join still decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import map_batches

_FACTORS = tuple(np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(hashes * c) >> np.uint64(64 - bits) for c in _FACTORS]


class HashFilter:
    """A Bloom filter as its filled parts of 4 KB; without any it lets nothing through."""

    def __init__(self, bits: int, parts: dict[int, bytes]):
        self.bits, self.parts = bits, parts
        self._bytes: np.ndarray | None = None

    def __or__(self, other: HashFilter) -> HashFilter:
        parts = dict(self.parts)
        for bucket, content in other.parts.items():
            if bucket in parts:
                content = (np.frombuffer(content, np.uint8) | np.frombuffer(parts[bucket], np.uint8)).tobytes()
            parts[bucket] = content
        return HashFilter(self.bits, parts)

    def __getstate__(self):
        return self.bits, {k: zlib.compress(v, 1) for k, v in self.parts.items()}

    def __setstate__(self, state):
        self.__init__(state[0], {k: zlib.decompress(v) for k, v in state[1].items()})

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not self.parts:
            return np.zeros(len(hashes), dtype=bool)
        if self._bytes is None:
            self._bytes = np.zeros(max(4096, 1 << self.bits >> 3), dtype=np.uint8)
            for bucket, content in self.parts.items():
                self._bytes[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(content, dtype=np.uint8)
        found = np.ones(len(hashes), dtype=bool)
        for p in probes(hashes, self.bits):
            found &= (self._bytes[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _probe_task(bits: int):
    """Places in the filter of each hash, counted from 1 as Spark's bitmaps do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in probes(batch.column("hash").to_numpy().view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array((p + np.uint64(1)).astype(np.int64))], ["place"])

    return run


def filter_of(hashes: DataFrame, bits: int) -> HashFilter:
    """The filter of ``hashes`` (hash long, not null). The driver gets bitmaps of 4 KB,
    2 ** bits / 32768 at most."""
    places = hashes.select("hash").transform(map_batches, _probe_task(bits), "place long")
    bitmaps = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    return HashFilter(bits, {row.bucket: bytes(row.bits) for row in bitmaps.collect()})


def _keep_task(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = broadcast.value.has(batch.column(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(known))

    return run


def mostly_in(rows: DataFrame, wanted: HashFilter) -> DataFrame:
    """Rows whose first column, a hash, is in the filter, and the few it can't tell apart."""
    broadcast = rows.sparkSession.sparkContext.broadcast(wanted)
    return rows.transform(map_batches, _keep_task(broadcast), rows.schema)
