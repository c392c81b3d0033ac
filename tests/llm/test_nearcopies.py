from __future__ import annotations

import random
from itertools import combinations

from eventlake.llm import nearcopies
from eventlake.llm.shared import text_or_empty


def texts(df):
    return df.select("doc_id", nearcopies.node().alias("node"), text_or_empty().cast("binary").alias("text"))


def survivors(df):
    """Smallest id of each class."""
    known = nearcopies.classes(texts(df).drop("doc_id"))
    return sorted(r[0] for r in texts(df).join(known, "node").groupBy("root").agg({"doc_id": "min"}).select("min(doc_id)").collect())


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_survivors(rows):
    """Smallest id of each component, by comparing every pair."""
    sets, parent = [plain_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(d, low.get(find(i), d))
    return sorted(low.values())


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def corpus(seed=3):
    """60 texts, each with four variants of similarity from about 0.65 to 0.98, and odd ones."""
    rng = random.Random(seed)
    texts = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 200, 600]))]
        texts += [edited(rng, words, round(len(words) * r)) for r in (0, 0.005, 0.018, 0.022, 0.035)]
    texts += ["", None, " \n", "one two", "One  TWO", "one two three"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_classes_are_those_of_brute_force(documents):
    rows = corpus()
    assert survivors(documents(rows, ["node", "root"])) == plain_survivors(rows)


def test_a_cluster_in_chunks(spark, documents):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, edited(rng, words, 3)) for i in range(60)]
    given = texts(documents(rows)).drop("doc_id")
    keyed = spark.createDataFrame(
        [(r.node, nearcopies.band_keys(nearcopies.shingles(bytes(r.text))).tolist()) for r in given.collect()],
        "node long, keys array<long>",
    )
    links = nearcopies.links(given, keyed, chunk=7)
    assert nearcopies.components(links).select("a").distinct().count() == 59


def test_a_large_group_of_near_copies(documents):
    """Each text moves once: a group of near copies is done with its first text."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, edited(rng, words, 1)) for i in range(5000)]
    assert survivors(documents(rows)) == [0]


def test_what_is_unlike_the_first_text_is_linked_too(documents):
    """A chain: neighbours are similar, the ends are not."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(f"new{i}" if i < 12 * k else w for i, w in enumerate(words))) for k in range(8)]
    assert len(plain_survivors(rows)) == 1 and survivors(documents(rows)) == [0]


def test_rows_without_words(documents):
    assert survivors(documents([])) == []
    assert survivors(documents([(3, None), (2, ""), (1, "a"), (5, "A")])) == [1, 2]
