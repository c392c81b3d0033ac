from __future__ import annotations

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from eventlake.llm import packing
from eventlake.llm.catalog import QUERIES

PATH = packing.public_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


ODD = (
    "It's <|endoftext|> o'clock a<|startoftext|>b 12 3.5 don't\x1c x\xa0y K Å é İ ΣΑΣ "
    "a_b foo.bar f(x) 你好 😀 WE'LL ﬁ ªºµ ÷ Straße STRASSE ẞ Ÿ end. em x\u0085y **bold** <b>"
)


def test_word_encoder_equals_the_tokenizer(tokenizer):
    encoder = packing.WordEncoder(PATH, words=50, parts=50)
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' LIMIT 60").fetchall()
    for text in [ODD, "", " ", "x" * 5000, *(t for (t,) in rows)]:
        got = np.frombuffer(encoder.encode(text.encode()), dtype="<u4").tolist()
        assert got == ids_of(tokenizer, text)[:-1]


@pytest.mark.parametrize("seed", range(8))
def test_pack(seed):
    rng = random.Random(seed)
    room = rng.choice([1, 7, 64, 2048])
    pieces = [(i, rng.randint(1, room)) for i in range(rng.randint(0, 400))]
    got = list(packing.pack(pieces, room, packing.Cost()))
    parts, places = defaultdict(list), defaultdict(list)
    for d, start, n, s, offset in got:
        assert n > 0
        parts[d].append((start, start + n))
        places[s].append((offset, offset + n))
    for spans, sizes in ((parts, dict(pieces)), (places, {s: room for s in places})):
        for k, found in spans.items():
            found.sort()
            assert found[0][0] == 0 and all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
            assert found[-1][1] <= sizes[k]
    assert all(parts[d][-1][1] == n for d, n in pieces)
    assert len(places) == -(-sum(n for _, n in pieces) // room)


def test_costs_are_balanced():
    rng = random.Random(1)
    pieces = [(i, rng.choice([100, 300])) for i in range(4000)]
    cost = packing.Cost()
    spent = defaultdict(float)
    for _, _, n, s, _ in packing.pack(pieces, 2048, cost):
        spent[s] += cost.of(n)
    in_turn, used, at = defaultdict(float), 0, 0
    for _, n in pieces:  # first come, first served
        if used + n > 2048:
            used, at = 0, at + 1
        used += n
        in_turn[at] += cost.of(n)
    spread = lambda x: np.std(list(x.values())) / np.mean(list(x.values()))
    assert spread(spent) < spread(in_turn)


def check(rows, docs, tokenizer, room=2048, padding=None):
    """Pieces tile every document and every sequence; checksums are those of the ids."""
    parts, places = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(parts) == {d for d, _ in docs}
    for d, text in docs:
        ids = np.array(ids_of(tokenizer, text), dtype="<u4")
        at = 0
        for r in sorted(parts[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= room
    if padding is not None:
        total = sum(r.length for r in rows)
        assert len(places) * room - total <= padding * total


def test_edge_cases(documents, tokenizer):
    docs = [(1, None), (2, ""), (3, ODD), (4, "word " * 30_000), (5, " \n"), (-6, "a b c")]
    df = documents(docs, ["start", "offset", "sequence_id"])
    check(packing.packed(df, PATH, group=2).collect(), docs, tokenizer)
    twice = packing.packed(documents([(None, "a b"), (7, "c"), (7, "c")]), PATH).collect()
    assert sorted((str(r.doc_id), r.length) for r in twice) == [("7", 2), ("7", 2), ("None", 3)]
    assert packing.packed(documents([]), PATH).count() == 0


def test_query(spark, tokenizer):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    check(QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect(), docs, tokenizer, padding=0.03)
