from __future__ import annotations

import random

import duckdb
import pytest

from eventlake.llm import decontaminate as D
from eventlake.llm.catalog import QUERIES


def nearest(item, text):
    """Least distance of item to a passage of text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


@pytest.mark.parametrize("seed", range(30))
def test_myers_against_the_table(seed):
    rng = random.Random(seed)
    letters = "ab " if seed % 2 else "abcdefghé "
    item = "".join(rng.choice(letters) for _ in range(rng.randint(1, 90)))
    text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
    best, end = D.myers(item, text)
    assert best == nearest(item, text)
    start = end - D.myers_start(item, text[:end], best)
    assert D.edit_distance(item, text[start:end]) == best == nearest(item, text[start:end])


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        chars[at : at + 1] = rng.choice([[], [chars[at], "q"], ["z"]])
    return "".join(chars)


ITEM = "The quick brown fox jumps over the lazy dog while seven wizards brew potions in the old tower"


def build(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_every_edit_within_the_budget_is_found(spark, documents):
    rng = random.Random(4)
    budget = D.Budget().edits(len(ITEM))
    rows, want = [], {}
    for i in range(120):
        copy = edited(rng, ITEM, i % (2 * budget))
        text = f"{'Some text before. ' * (i % 5)}{copy.upper() if i % 3 else copy}{' and more behind it' * (i % 4)}"
        rows.append((i, text))
        d = nearest(D.normal(ITEM), D.normal(text))
        if d <= budget:
            want[i] = d
    got = {r.doc_id: r for r in D.leaks(documents(rows), build(spark, [(1, ITEM)])).collect()}
    assert {i: r.distance for i, r in got.items()} == want
    for i, r in got.items():
        assert abs(r.end - r.start - len(ITEM)) <= 2 * budget + 2, rows[i][1][r.start : r.end]


def test_edge_cases(spark, documents):
    rows = [(1, None), (2, ""), (None, ITEM), (3, ITEM), (3, ITEM), (4, "x " * 50_000 + ITEM.replace(" ", "\n \t")), (5, ITEM[:40])]
    items = [(7, ITEM), (8, ITEM), (9, None), (10, ""), (11, "short"), (None, ITEM)]
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in D.leaks(documents(rows, ["item_id", "start"]), build(spark, items)).collect()), key=str)
    assert got == sorted(((d, i, 0) for d in (None, 3, 3, 4) for i in (7, 8, None)), key=str)
    assert D.leaks(documents([]), build(spark, items)).count() == 0
    assert D.leaks(documents(rows), build(spark, [])).count() == 0
    clean = D.decontaminate(documents(rows, ["item_id"]), build(spark, items))
    assert sorted((r.doc_id, r.text) for r in clean.collect() if r.text) == [(5, ITEM[:40])]
    assert clean.count() == 3 and D.decontaminate(documents(rows), build(spark, [])).count() == len(rows)


def test_blocks_of_items_give_the_same(spark, documents):
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for i in range(30)]
    rows = [(i, f"before {items[i % 30][1]} between {items[(i * 7) % 30][1]}") for i in range(60)]
    one = sorted(map(tuple, D.leaks(documents(rows), build(spark, items)).collect()))
    many = sorted(map(tuple, D.leaks(documents(rows), build(spark, items), block_bytes=500).collect()))
    assert one == many and len(one) >= 100


def test_query_against_search_by_hand(spark):
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    whole = {(d, i) for d, t in docs for i, s in items if D.normal(s) in D.normal(t or "")}
    got = QUERIES["op4_decontaminate"](spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.distance == 0} == whole
    text, item = dict(docs), dict(items)
    for r in got:
        assert nearest(D.normal(item[r.item_id]), D.normal(text[r.doc_id][r.start : r.end])) == r.distance


def test_short_items_are_found_as_whole_words(spark, documents):
    items = spark.createDataFrame([(1, "Who is Ada?"), (2, "art"), (3, "日本の首都"), (4, " "), (5, None)], "item_id long, text string")
    rows = [(1, "x who  is ada? y"), (2, "the party starts"), (3, "party of art, art"), (4, "これは日本の首都です"), (5, "who is adam")]
    got = D.leaks(documents(rows), items).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 0, 2, 14), (3, 2, 0, 9, 12), (4, 3, 0, 3, 8)]
    assert {r.doc_id for r in D.decontaminate(documents(rows), items).collect()} == {2, 5}
