from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from eventlake.llm import collocations as C
from eventlake.llm.words import blocks, split_words

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, s: C.Settings):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, s.max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    often = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= s.threshold}
    inside = {
        (lang, p[i : i + m])
        for (lang, p), n in often.items()
        for m in range(2, len(p))
        for i in range(len(p) - m + 1)
        if 100 * n >= s.contained_percent * often[lang, p[i : i + m]]
    }
    by_lang = {}
    for (lang, p), a in often.items():
        if (lang, p) not in inside:
            score, _, left, right = min(
                (2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                for k in range(1, len(p))
            )
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in by_lang.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[: s.first], 1)
    )


def corpus(n=150):
    rng = random.Random(5)
    words = ["la", "Le", "été", "Zu", "x", "İ", "wort", "a-b", "\x00y"] + [f"w{i}" for i in range(20)]
    phrases = ["new york city", "san  francisco", "hot\tdog stand now", "le\x0bchat"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(words + phrases) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "fr", None]), "".join(p + rng.choice([" ", "  ", ". ", "\n", "\t", ","]) for p in parts)))
    odd = [("en", None), ("en", ""), ("", " \t"), ("en", "..."), ("fr", "no end"), ("und", "la Le")]
    # Repeats overlap: five in a row are two of four.
    many = [("de", "ho ho ho ho ho")] * 12 + [("long", "one two three four five " * 3000)]
    return rows + odd + many


@pytest.mark.parametrize("settings", [
    C.Settings(threshold=5, shards=3, first=40, block=2000),
    C.Settings(threshold=4, shards=2, first=9, filter_bits=15, block=300),
])
def test_same_as_plain_counts(spark, settings):
    rows = corpus()
    types = "doc_id long, lang string, text string, phrase string, n long, shard long, place long"
    docs = spark.createDataFrame([(i % 7, lang, t, "x", 1, 2, 3) for i, (lang, t) in enumerate(rows)], types)
    got = C.collocations(docs, settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == plain(rows, settings)
    assert {r[0] for r in found} >= {"en", "fr", "und", "de", "long"}


def test_no_texts(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert C.collocations(docs, C.Settings(shards=1)).collect() == []


def test_counts_past_64_bits(spark):
    big = 9_000_000_000_000_000
    rows = [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)]
    (row,) = C.scored(spark.createDataFrame(rows, "lang string, phrase string, len int, n long")).collect()
    assert (row.score, row.l, row.r) == (2_000_000 * (big - 1) // (2 * big), big, big)
    wide = spark.createDataFrame(
        [("en", "a b", 2, 10**17 - 1, 1, 1, 1), ("en", "a b c", 3, 8 * 10**16, 1, 1, 1)],
        "lang string, phrase string, len int, a long, l long, r long, score long",
    )
    assert [r.phrase for r in C.not_contained(wide, 80).collect()] == ["a b c"]


def test_filter_lets_all_its_phrases_through():
    hashes = C.word_hashes([b"w%d" % i for i in range(5000)], "en")
    for bits in (15, 20):
        parts = {}
        for p in np.concatenate(C.probes(hashes, bits)).tolist():
            part = parts.setdefault(p // 32768 + 1, bytearray(4096))
            part[p % 32768 // 8] |= 1 << p % 8
        full = C.HashFilter(bits, {k: bytes(v) for k, v in parts.items()})
        assert full.has(hashes).all()
    others = C.word_hashes([b"v%d" % i for i in range(5000)], "en")
    assert full.has(others).mean() < 0.01
    assert not C.HashFilter(15, {}).has(hashes).any()


@pytest.mark.parametrize("size", [1, 7, 64, 10**6])
def test_blocks_cut_between_words(size):
    text = b"ein langes wort, zwei  drei\tvier funf. " * 9 + b"x" * 100
    whole = split_words(text, C.CLASSES)
    got = []
    for data, limit in blocks(text, size, C.CLASSES, 3):
        w = split_words(data, C.CLASSES)
        names = w.names.to_pylist()
        got += [names[i] for i, at in zip(w.ids, w.starts, strict=True) if at < limit]
    names = whole.names.to_pylist()
    assert got == [names[i] for i in whole.ids]
