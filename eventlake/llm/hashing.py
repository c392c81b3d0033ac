"""Nearest neighbours by multi-index hashing of learned binary codes.

A few rotations of the main directions of a sample are learned so that the signs of the
rotated components keep the vectors apart with the least loss (iterative quantization).
The signs of all rotations are the code of a vector. Codes are cut into substrings, and
each substring has an index of its own, from value to rows. Two codes that differ in at
most r bits differ in at most r / m bits in one of the m substrings, so probing all
values that near in each index finds every code within r. These are checked by all
their bits, and their vectors are compared in double precision.

The index lies in blocks of rows; the queries visit every block, and each block returns
its nearest few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import map_batches, stored


@dataclass(frozen=True)
class Settings:
    """``bits`` is a multiple of 64. ``sample_values``: the model and the radius are fitted on
    so many components, at most ``sample_rows`` vectors; all rows are indexed.
    ``covered``: the share of the sample's true neighbours that the radius covers.
    ``at_once``: pairs of rows a task looks at together."""

    found: int = 5
    bits: int = 128
    substring: int = 16
    sample_rows: int = 4096
    sample_values: int = 1 << 20
    covered: float = 0.98
    block_rows: int = 1 << 16
    at_once: int = 1 << 20
    steps: int = 30


@dataclass(frozen=True)
class Model:
    """Codes: signs of ``(unit vector - centre) @ axes``. ``radius`` in bits."""

    centre: np.ndarray
    axes: np.ndarray
    radius: int


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Times a power of two for each row, so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def units(vectors: np.ndarray) -> np.ndarray:
    near_one = scaled(vectors)
    return near_one / np.sqrt((near_one * near_one).sum(axis=1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows of two arrays, pair by pair; equal pairs give equal bits."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def rotation(points: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """The rotation that brings points nearest to their own signs."""
    size = points.shape[1]
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]
    for _ in range(steps):
        signs = np.where(points @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ points)
        turn = right.T @ left.T
    return turn


def encoded(vectors: np.ndarray, centre: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Codes as rows of unsigned 64-bit words."""
    signs = (units(vectors) - centre) @ axes > 0
    return np.packbits(signs, axis=1).view(np.uint64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def fitted(sample: np.ndarray, settings: Settings) -> Model:
    """Model of a sample, and the radius that covers its own nearest neighbours."""
    unit = units(sample)
    centre = unit.mean(axis=0)
    _, directions = np.linalg.eigh((unit - centre).T @ (unit - centre))
    main = directions[:, ::-1][:, : settings.bits]
    points = (unit - centre) @ main
    turns = -(-settings.bits // main.shape[1])
    axes = np.hstack([main @ rotation(points, settings.steps, seed) for seed in range(turns)])[:, : settings.bits]
    codes = encoded(sample, centre, axes)
    asked = range(0, len(sample), max(1, len(sample) // 512))
    seen = []
    for i in asked:
        near = unit @ unit[i]
        near[i] = -np.inf
        best = np.argsort(-near)[: min(settings.found, len(sample) - 1)]
        seen.append(distances(codes[best], codes[i]))
    far = np.concatenate(seen) if seen else np.zeros(0)
    radius = int(np.ceil(np.quantile(far, settings.covered))) if len(far) else settings.bits
    return Model(centre, axes, radius)


def substring_radii(radius: int, parts: int) -> list[int]:
    """Within ``radius`` bits in all, one part lies within its own; -1: not needed."""
    each, rest = divmod(radius, parts)
    return [each if i <= rest else each - 1 for i in range(parts)]


class Block:
    """Rows of the index with an index for each substring."""

    def __init__(self, row_ids, vec_ids, codes, vectors, settings: Settings):
        self.row_ids, self.vec_ids, self.codes, self.vectors = row_ids, vec_ids, codes, vectors
        self.settings = settings
        # For each substring: the values that occur, and which of them each row has.
        parts = self._parts(codes)
        self.values = [np.unique(parts[:, j], return_inverse=True) for j in range(parts.shape[1])]

    def _parts(self, codes: np.ndarray) -> np.ndarray:
        return codes.view(f"u{self.settings.substring // 8}")

    def probe(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all codes within ``radius`` of each query's."""
        parts = self._parts(codes)
        near = np.zeros((len(codes), len(self.codes)), dtype=bool)
        for j, within in enumerate(substring_radii(radius, parts.shape[1])):
            if within >= 0:
                values, rows = self.values[j]
                hit = np.bitwise_count(parts[:, j, None] ^ values[None, :]) <= within
                near |= hit[:, rows]
        query, row = np.nonzero(near)
        exact = distances(codes[query], self.codes[row]) <= radius
        return query[exact], row[exact]

    def nearest(self, row_ids, codes, vectors, radius: int) -> tuple[np.ndarray, ...]:
        """(query, vec_id, score) of the nearest rows of this block to each query."""
        query, row = self.probe(codes, radius)
        other = self.row_ids[row] != row_ids[query]
        query, row = query[other], row[other]
        score = np.empty(len(row))
        step = max(1, (1 << 22) // self.vectors.shape[1])
        for i in range(0, len(row), step):
            part = slice(i, i + step)
            score[part] = cosines(vectors[query[part]], self.vectors[row[part]])
        vec_id, known = self.vec_ids
        order = np.lexsort((vec_id[row], ~known[row], -score, query))
        query, row, score = query[order], row[order], score[order]
        first = np.searchsorted(query, query)
        best = np.arange(len(query)) - first < self.settings.found
        return query[best], row[best], score[best]


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _encode_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = encoded(_vectors(batch.column("vector")), model.centre, model.axes)
                column = pa.FixedSizeListArray.from_arrays(pa.array(codes.view(np.int64).ravel()), codes.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, column.cast(pa.list_(pa.int64()))], ["vec_id", "vector", "code"]
                )

    return run


def _search_task(radius: int, settings: Settings):
    """Rows come by block, those of the index before the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column("block").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                rows = batch.slice(start, stop - start)
                if number != at[start]:
                    number, held, block = at[start], [], None
                if not asks[start]:
                    held.append(rows)
                    continue
                if block is None:
                    block = _block(held, settings)
                    held = []
                step = max(1, settings.at_once // max(1, len(block.codes)))
                for i in range(0, rows.num_rows, step):
                    yield _answers(block, rows.slice(i, step), radius)

    return run


def _columns(rows: pa.RecordBatch) -> tuple:
    codes = np.ascontiguousarray(_vectors(rows.column("code"))).view(np.uint64)
    ids = rows.column("vec_id")
    vec_ids = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
    return rows.column("row_id").to_numpy(), vec_ids, codes, _vectors(rows.column("vector"))


def _block(held: list[pa.RecordBatch], settings: Settings) -> Block:
    return Block(*_columns(pa.Table.from_batches(held).combine_chunks().to_batches()[0]), settings)


def _answers(block: Block, asked: pa.RecordBatch, radius: int) -> pa.RecordBatch:
    row_ids, _, codes, vectors = _columns(asked)
    query, row, score = block.nearest(row_ids, codes, vectors, radius)
    vec_id, known = block.vec_ids
    columns = [
        pa.array(row_ids[query]), asked.column("vec_id").take(pa.array(query)),
        pa.array(vec_id[row], pa.int64(), mask=~known[row]), pa.array(score),
    ]
    return pa.RecordBatch.from_arrays(columns, ["row_id", "query_id", "vec_id", "score"])


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vector) of vectors that are not null, not zero and hold finite numbers only."""
    vector = F.col("embedding").cast("array<double>").alias("vector")
    got = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector)
    good = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return got.filter(good & F.exists("vector", lambda x: x != 0))


def _search(index: DataFrame, queries: DataFrame, blocks: int, radius: int, settings: Settings) -> DataFrame:
    own = F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int")
    rows = index.select(own.alias("block"), F.lit(False).alias("asks"), *index.columns)
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), *index.columns
    )
    met = rows.unionByName(asked).repartition("block").sortWithinPartitions("block", "asks", "row_id")
    found = met.transform(
        map_batches, _search_task(radius, settings), "row_id long, query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("row_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= settings.found)


def nearest(rows: DataFrame, every: int = 50, settings: Settings = Settings()) -> DataFrame:
    """The nearest rows found for each row whose vec_id ``every`` divides: query_id, rank,
    vec_id, score (cosine), nearest first, equal ones by vec_id, a null one last.

    Null, zero and non-finite vectors take no part. If vectors differ in length, those
    of the most frequent length take part (the longest of several). Repeated rows are
    rows of their own: each is a candidate of the others, and each asks if its id does.
    A query that finds fewer than ``found`` within the radius is asked again over all
    codes, so it gets all candidates there are. Components may be of any size. An
    empty table gives no rows. Further columns are not looked at.
    """
    spark = rows.sparkSession
    good = usable(rows)
    sizes = good.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return spark.range(0).selectExpr("id AS query_id", "int(id) AS rank", "id AS vec_id", "double(id) AS score")
    good = good.filter(F.size("vector") == most["size"])
    # A bounded part of the rows, the same on every run.
    n = max(64, min(settings.sample_rows, settings.sample_values // most["size"]))
    sample = good.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(n).collect()
    model = fitted(np.array([r.vector for r in sample]), settings)
    coded = good.transform(map_batches, _encode_task(model), "vec_id long, vector array<double>, code array<long>")
    index = stored(coded.withColumn("row_id", F.monotonically_increasing_id()), "codes")
    queries = index.filter(F.col("vec_id") % every == 0)
    blocks = -(-most["n"] // settings.block_rows)
    found = stored(_search(index, queries, blocks, model.radius, settings), "nearest")
    full = found.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(settings.found, most["n"] - 1))
    few = stored(queries.join(full, "row_id", "left_anti").select(*index.columns), "asked_again")
    again = _search(index, few, blocks, settings.bits, settings)
    done = found.join(full, "row_id", "left_semi").unionByName(again)
    return done.select("query_id", "rank", "vec_id", "score")
