from __future__ import annotations

import zlib
from collections import defaultdict

import duckdb

from eventlake.llm import sharding
from eventlake.llm.catalog import QUERIES


def check(rows, docs, shards=40):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs), key=str
    )
    total, largest = sum(r.size for r in rows), max((r.size for r in rows), default=0)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if largest * shards < total:
        assert all(abs(sizes[s] - total / shards) <= largest for s in range(shards))


EDGES = [(i, None) for i in range(5)] + [(None, "x")] * 3 + [(9, "y" * 5000)] + [(i, "same text é") for i in range(20, 320)]


def test_edge_cases(documents):
    check(sharding.sharded(documents(EDGES, ["shard", "slot", "size"])).collect(), EDGES)
    check(sharding.sharded(documents([(1, "a")])).collect(), [(1, "a")])
    assert sharding.sharded(documents([])).count() == 0


def test_query_and_that_equal_texts_keep_together(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    rows = QUERIES["op5_sharding"](spark, "/root/testdata/sf0.01").collect()
    check(rows, docs)
    of = {r.doc_id: r.shard for r in rows}
    groups = defaultdict(set)
    for d, t in docs:
        groups[t].add(of[d])
    assert sum(len(g) > 1 for g in groups.values()) <= 39


def test_order_is_contiguous_and_same_for_any_partitioning(spark, documents):
    from pyspark.sql import functions as F

    rows = documents([(i, "ab" * (i % 50)) for i in range(1000)])
    found = []
    for n in (1, 7):
        cut = sharding.cut(rows.repartition(n).select("doc_id", F.octet_length("text").cast("long").alias("size")), F.col("size"), 10, F.col("doc_id"))
        found.append(sorted((r.doc_id, r.shard, r.slot) for r in cut.collect()))
    assert found[0] == found[1] and [s for _, s, _ in found[0]] == sorted(s for _, s, _ in found[0])


def test_written_shards(documents, folder):
    rows = documents(EDGES)
    out = sharding.write_shards(rows, f"{folder}/shards", 5)
    assert sorted(map(str, out.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    assert out.select("shard").distinct().count() == 5


def test_main_path_has_no_python(spark):
    plan = QUERIES["op5_sharding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
