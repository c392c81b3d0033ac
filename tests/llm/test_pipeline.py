"""Each stage on its own input, and the whole, against plain code."""

from __future__ import annotations

import re

import duckdb
import pytest
from test_decontaminate import nearest
from test_lines import plain as figures
from test_packing import check
from test_simhash import plain_components
from tokenizers import Tokenizer

import corpus_pipeline
from eventlake.llm import decontaminate, packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
        out.append((before, docs.collect(), docs.columns))
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "benchmark_decontamination", "secret_scans", "pack",
    ]


def test_columns(stages):
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for *_, columns in stages[:-1])
    assert all(r.n_chars == len(r.text) for _, after, _ in stages[:-1] for r in after)


def test_quality_rules(stages):
    before, after, _ = stages[0]
    # No line of this small table is in more than 20 documents of a host.
    want = {r.doc_id: r.text for r in before if not figures(r.text)[-1]}
    assert {r.doc_id: r.text for r in after} == want


def test_near_dedup(stages):
    before, after, _ = stages[1]
    components = plain_components([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for *_, c in components})


def test_decontamination(stages):
    before, after, _ = stages[2]
    items = [decontaminate.normal(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    left = {r.doc_id for r in after}
    gone = [r for r in before if r.doc_id not in left]
    assert gone
    for r in gone:
        text = decontaminate.normal(r.text)
        assert any(nearest(i, text) <= decontaminate.Budget().edits(len(i)) for i in items)
    assert not any(i in decontaminate.normal(r.text) for r in after for i in items)


def test_secrets(stages):
    before, after, _ = stages[3]
    assert {r.doc_id for r in before} == {r.doc_id for r in after} and len(before) == len(after)
    text = {r.doc_id: r.text for r in after}
    for r in before:
        new = text[r.doc_id]
        assert not re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", new)
        parts = new.split("[SECRET]")
        assert r.text.startswith(parts[0]) and r.text.endswith(parts[-1])
        if len(parts) == 1:
            assert new == r.text
    assert any("[SECRET]" in t for t in text.values()) == any(re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r.text) for r in before)


def test_pack(stages):
    before, after, _ = stages[4]
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    check(after, [(r.doc_id, r.text) for r in before], tokenizer, padding=0.05)


def test_run_is_all_stages(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in stages[-1][1])
    assert {r.doc_id for r in whole} == {r.doc_id for r in stages[-1][1]}
    assert len({key(r) for r in whole}) == len(whole)


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, fingerprint_ string, removed string, row_ int"
    rows = [(None, None, None, None, None, "x", "y", 1), (1, "", "", "", 0, "x", None, 2), (2, "a b c d e f g h i j k l", None, None, 1, None, "", 3)] * 2
    rows += [(3, "word " * 40_000 + "secret = abcdef123", "en", "s", 5, "", "", 4)]
    for given in ([], rows):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "pack":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            docs = corpus_pipeline.stored(out, "odd") if name != "pack" else out
        assert docs.count() == (0 if not given else 1)
