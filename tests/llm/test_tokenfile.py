from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from eventlake.llm import tokenfile
from eventlake.llm.catalog import QUERIES

RANKS = tokenfile.public_ranks()


def plain(rows):
    encode = tokenfile.encoding(RANKS).encode_ordinary
    return sorted(((i, len(encode(t or ""))) for i, t in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_tokens").collect()), key=str)


def test_counts(spark, documents):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> é😀"), (None, "a b"), (4, "x"), (4, "x"), (5, "long text " * 40_000)]
    assert found(tokenfile.counted(spark, documents(rows, ["n_tokens", "file", "bytes"]), RANKS)) == plain(rows)
    assert tokenfile.counted(spark, documents([]), RANKS).count() == 0


def test_query(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert found(QUERIES["op8_tokenfile"](spark, "/root/testdata/sf0.001")) == plain(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 64, 100_000])
def test_blocks_cut_anything(spark, folder, block):
    rng = random.Random(block)
    files, want = [], []
    for n, shape in enumerate(["", "E", "EE", "tE", "t", "EtttE", "".join(rng.choice("ttttE") for _ in range(500)), "t" * 90]):
        path = f"{folder}/{n}.tokens"
        ids = np.array([tokenfile.END if c == "E" else rng.randrange(50_000) for c in shape], dtype="<u2")
        ids.tofile(path)
        files.append((path, ids.nbytes))
        at = 0
        for k, part in enumerate(shape.split("E")):
            if part or k < shape.count("E"):
                want.append((path, k, at, len(part)))
            at += len(part) + 1
    df = spark.createDataFrame(files, "file string, bytes long")
    got = tokenfile.scan_files(df, block=block).select("file", "ordinal", "start", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_small_files(spark, documents, folder):
    rows = [(i, f"text number {i} " * (i % 9)) for i in range(300)]
    written = tokenfile.write_tokens(documents(rows), f"file://{folder}/t", RANKS, file_bytes=500)
    assert written.filter("ordinal IS NULL").count() > 10
    found_rows = tokenfile.scan_files(written.filter("ordinal IS NULL").select("file", "bytes"), block=97)
    got = written.filter("ordinal IS NOT NULL").join(found_rows, ["file", "ordinal"]).select("doc_id", "n_tokens")
    assert found(got) == plain(rows)
