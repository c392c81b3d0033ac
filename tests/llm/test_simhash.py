from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
import xxhash

from eventlake.llm import simhash
from eventlake.llm.catalog import QUERIES


def plain_fingerprint(text):
    raw = (text or "").encode()
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", raw) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """(doc_id, fingerprint, smallest reachable id) by comparing every pair."""
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_fingerprint_by_definition():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, 4, 50, 3000]:
        text = rng.choice(["", " ", "\n"]) + " ".join(rng.choice(["Aé", "bX", "c\x0b", "ÄÖ"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def test_text_longer_than_a_block_of_words():
    text = " ".join(f"w{i % 9973}" for i in range(300_000))
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 7])
@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 700])
def test_near_finds_every_pair(radius, n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, size=max(1, n // 5), dtype=np.uint64)
    fps = rng.choice(base, n)
    for _ in range(5):
        fps ^= np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    got = {i: set(np.flatnonzero(np.unpackbits(r.view(np.uint8), bitorder="little"))) for i, r in simhash.near(fps, radius)}
    distance = np.bitwise_count(fps[:, None] ^ fps[None, :])
    want = {i: set(np.flatnonzero(d <= radius)) for i, d in enumerate(distance)}
    assert got == {i: w for i, w in want.items() if len(w) > 1}


def test_hot_key_is_split_and_stays_whole(spark):
    rng = np.random.default_rng(3)
    fps = {0x0F0F << 40}
    while len(fps) < 400:
        fps.add(random.Random(len(fps)).choice(sorted(fps)) ^ (1 << int(rng.integers(0, 20))))
    rows = [(int(f) - (1 << 64) if f >> 63 else int(f),) for f in fps]
    nodes = spark.createDataFrame(rows, "fp long")
    for chunk in (8, 64, 10_000):
        roots = simhash.components(simhash.links(nodes, 3, chunk)).collect()
        assert len(roots) == len(rows) - 1 and {r.root for r in roots} == {min(r[0] for r in rows)}


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(-5, -7)], "a long, b long")
    got = {r.a: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {-5: -7}


EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two"),
    (7, "a b c d e f g h i j"), (7, "a b c d e f g h i j"), (8, "A B C D E F G H I J"), (None, "lonely text of a row"),
    (9, "x " * 5000), (9, "another text under a used id"), (-3, "x " * 4000),
]


def test_edge_cases_against_every_pair(documents):
    df = documents(EDGES, ["fingerprint", "component_id", "fp", "root"])
    assert found(simhash.near_duplicates(df)) == plain_components(EDGES)


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.without_near_duplicates(documents([])).count() == 0


def test_query_against_every_pair(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert found(QUERIES["op2_simhash"](spark, "/root/testdata/sf0.001")) == plain_components(rows)


def test_one_row_of_each_component_stays(documents):
    df = documents(EDGES, ["fingerprint"])
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    name = lambda c, f: f if c is None else c
    component = {(d, f): name(c, f) for d, f, c in plain_components(EDGES)}
    got = [(r.doc_id, f"{plain_fingerprint(r.text):016x}") for r in kept.collect()]
    assert sorted(component[x] for x in got if x[0] is not None) == sorted(c for c in set(component.values()) if not isinstance(c, str))
    assert all(component[d, f] == d for d, f in got if d is not None)
    assert sorted(component[x] for x in got if x[0] is None) == sorted(c for c in set(component.values()) if isinstance(c, str))


def test_whole_rows_go_through_python_once(documents):
    """The kept rows come from stored fingerprints; the UDF does not run on them again."""
    df = documents(EDGES, ["fingerprint"])
    kept = simhash.without_near_duplicates(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert kept.count() == kept.dropDuplicates(["doc_id", "text"]).count()
