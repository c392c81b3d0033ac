from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from eventlake.llm import divergence as D

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least=10, first=10):
    count, within, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall((text or "").translate(UPPER))
        count[lang, source].update(terms)
        within[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in within[lang].items() if n >= least]

        def shares(of):
            n = sum(of[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (of[t] + 2) // n for t in kept}

        share = {s: shares(count[lang, s]) for s in sources}
        everywhere = shares(sum((count[lang, s] for s in sources), Counter()))

        def f(p, q):
            return (p - q) * (p - q) // (p + q)

        for s in sources:
            pairs = [(-sum(f(share[s][t], share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [
                (-f(share[s][t], everywhere[t]), t.encode(), t)
                for t in kept
                if count[lang, s][t] and share[s][t] > everywhere[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:first])):
                out += [(lang, s, part, item, -v, rank) for rank, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(3)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["Été", "İx", "ñ", "naïve", "the"]
    rows = []
    for i in range(300):
        lang = rng.choice(["en", "fr", None])
        source = rng.choice(["s1", "s2", "s3", "é", "", None])
        pool = words[: 10 + 5 * (hash_of(source) % 4)]
        text = "".join(rng.choice(pool) + rng.choice([" ", "-", "7", "\n", "@"]) for _ in range(rng.randrange(30)))
        rows.append((text, lang, source))
    rows += [(None, "en", "s9"), ("", "en", "s9"), ("...", "xx", "s1"), ("x", "xx", None), ("one", "yy", "s1")]
    rows += [("copy of a text " * 3, "fr", "s1")] * 40
    rows += [("a long text of the en kind " * 2000, "en", "s2")]
    return rows


def hash_of(source):
    return sum((source or "").encode())


def table(spark, rows):
    types = "text string, lang string, source string, term string, items long, p long, value long, docs long"
    return spark.createDataFrame([(*r, "t", 1, 2, 3, 4) for r in rows], types)


def test_same_as_plain_sums(spark):
    rows = corpus()
    got = D.divergence(table(spark, rows))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_long_texts_in_small_blocks(spark):
    rows = corpus()
    got = {(r.lang, r.term): (r.total, sorted(map(tuple, r["items"]))) for r in D.kept_terms(table(spark, rows), block=500).collect()}
    want = {(r.lang, r.term): (r.total, sorted(map(tuple, r["items"]))) for r in D.kept_terms(table(spark, rows)).collect()}
    assert got == want and got


def test_no_documents(spark):
    assert D.divergence(table(spark, [])).collect() == []


def test_tree_counts_each_node_and_ancestor_once():
    rng = random.Random(1)
    rows = Counter()
    for _ in range(400):
        k = rng.randrange(1, 6)
        sources = sorted(rng.sample("abcdefg", k))
        rows[tuple((s, n := rng.randrange(1, 3), 1000 * n + ord(s), 400 + ord(s)) for s in sources)] += rng.randrange(1, 4)
    want = Counter()
    for items, times in rows.items():
        for i, a in enumerate(items):
            for b in items[i + 1 :]:
                f = lambda p, q: (p - q) ** 2 // (p + q)
                want[a[0], b[0]] += times * (f(a[2], b[2]) - f(a[2], b[3]) - f(a[3], b[2]) + f(a[3], b[3]))
    tree, nodes = D.Tree(), 0
    for items in sorted(rows):
        tree.insert(list(items), rows[items])
    tree.leave(0)
    nodes = sum(len(c) for c, _ in tree.closed)
    a, b, value = tree.take()
    assert dict(zip(zip(a, b, strict=True), value.tolist(), strict=True)) == dict(want)
    # Shared paths: one correction a node and ancestor, not one a row.
    distinct = {items[:k] for items in rows for k in range(1, len(items) + 1)}
    assert nodes == sum(len(path) - 1 for path in distinct)
    assert nodes < sum(times * len(items) * (len(items) - 1) // 2 for items, times in rows.items())


def test_counts_past_64_bits(spark):
    from pyspark.sql import functions as F

    n, z = 90_000_000_000, 9_000_000_000_000
    row = spark.createDataFrame([(n, z)], "n long, z long").select(D._share(F.col("n"), F.col("z")).alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (n + 2) // z
    assert int(D._apart(np.int64(10**9 + 1), np.int64(1))) == (10**9) ** 2 // (10**9 + 2)
