"""Source divergence: how far the word use of each source lies from the others of its language.

The divergence of two sources is a sum over all kept terms. It is split so that no term
is looked at for a pair of sources that both lack it:

- all terms, as if no source had any: one value for each pair;
- corrections for the terms of one source alone: from a histogram of its counts;
- corrections for terms that both sources have: from a frequent-pattern tree.

A term is a row of (source, count) in the order of the sources, zero counts left out. Equal
rows are one row with a multiplicity, and rows that begin alike share nodes of the tree. A
node carries the multiplicity of all rows through it, and the corrections between a node
and its ancestors are made once, times that number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import map_batches, stored, text_or_empty
from eventlake.llm.words import blocks, byte_classes, gathered, split_words

# All of ASCII but its letters lies between terms.
CLASSES = byte_classes(bytes(b for b in range(128) if not chr(b).isalpha()), b"")
MIN_DOCUMENTS, SCALE, FIRST = 10, 1_000_000_000, 10


def _texts_counted(texts: list[bytes], block: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(terms, occurrences, texts they are in); a term of a long text comes once a block."""
    if len(texts) == 1:
        seen: set[bytes] = set()
        for data, _ in blocks(texts[0].lower(), block, CLASSES):
            w = split_words(data, CLASSES)
            names = w.names.to_pylist()
            new = np.array([n not in seen for n in names], dtype=np.int64)
            seen.update(names)
            yield w.names, np.bincount(w.ids, minlength=len(names)), new
        return
    w = split_words(b" ".join(texts).lower(), CLASSES)
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, w.starts, side="right")
    once = np.unique(text * max(1, len(w.names)) + w.ids) % max(1, len(w.names))
    yield w.names, np.bincount(w.ids, minlength=len(w.names)), np.bincount(once, minlength=len(w.names))


def _term_task(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(key: tuple, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            for names, n, texts_with in _texts_counted(texts, block):
                columns = [
                    *(pa.repeat(pa.scalar(k, pa.string()), len(names)) for k in key),
                    names.cast(pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(texts_with, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        yield from gathered(batches, block, work)

    return run


def _named(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, block: int = 4 << 20) -> DataFrame:
    """(lang, term, total, items): occurrences of each kept term in all of its language
    and by source. ``items`` has an entry a source at most."""
    texts = docs.select(*_named(docs), text_or_empty().cast("binary").alias("text"))
    counted = texts.transform(
        map_batches, _term_task(block), "lang string, source string, term string, n long, docs long"
    )
    by_source = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        by_source.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("items"),
        )
        .filter(F.col("docs") >= min_documents)
        .select("lang", "term", "total", "items")
    )


def _share(count: Column, size: Column) -> Column:
    """Smoothed share of a term in billionths, plus one; decimals, as products pass 64 bits."""
    parts = F.struct(
        (F.lit(SCALE).cast("decimal(38,0)") * (count + 2).cast("decimal(20,0)")).cast("decimal(38,0)").alias("n"),
        size.cast("decimal(38,0)").alias("d"),
    )
    return F.transform(F.array(parts), lambda x: F.call_function("div", x["n"], x["d"]))[0].cast("long") + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q).cast("long")


def sizes(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """One row for each (lang, source) that occurs: terms kept in the language, ``v``, the
    sizes ``z`` and ``z_lang`` of source and language with smoothing, and ``p0``, the
    share of a term that does not occur in the source."""
    groups = docs.select(*_named(docs)).distinct()
    n = (
        terms.select(F.col("lang").alias("n_lang"), F.explode("items").alias("x"))
        .groupBy("n_lang", F.col("x.source").alias("n_source"))
        .agg(F.sum("x.n").alias("n"))
    )
    v = terms.groupBy(F.col("lang").alias("v_lang")).agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_all"))
    joined = groups.join(n, (F.col("lang") == F.col("n_lang")) & (F.col("source") == F.col("n_source")), "left").join(
        v, F.col("lang") == F.col("v_lang"), "left"
    )
    none = F.lit(0).cast("long")
    filled = joined.select(
        "lang", "source", F.coalesce("v", none).alias("v"),
        (F.coalesce("n", none) + 2 * F.coalesce("v", none)).alias("z"),
        (F.coalesce("n_all", none) + 2 * F.coalesce("v", none)).alias("z_lang"),
    )
    # Without a kept term no share is ever asked for.
    return filled.withColumn("p0", F.when(F.col("v") > 0, _share(none, F.greatest("z", F.lit(1)))).otherwise(F.lit(1)))


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Tree:
    """A frequent-pattern tree that is filled by sorted rows, and so only ever holds the
    path of the last row: a node that is left behind is complete.

    ``closed`` collects the corrections of complete nodes with their ancestors.
    """

    def __init__(self):
        self.path: list[tuple] = []
        self.p = self.p0 = self.at = np.zeros(0, dtype=np.int64)
        self.through: list[int] = []
        self.sources: dict[str, int] = {}
        self.closed: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def insert(self, items: list[tuple], times: int) -> None:
        """``items``: (source, count, share, share without the term) by source."""
        shared = 0
        while shared < min(len(items), len(self.path)) and items[shared][:2] == self.path[shared][:2]:
            shared += 1
        self.leave(shared)
        self.path = items
        self.through = self.through[:shared] + [0] * (len(items) - shared)
        self.through = [n + times for n in self.through]
        self.at = np.array([self.sources.setdefault(x[0], len(self.sources)) for x in items], dtype=np.int64)
        self.p = np.array([x[2] for x in items], dtype=np.int64)
        self.p0 = np.array([x[3] for x in items], dtype=np.int64)

    def leave(self, depth: int) -> None:
        """Closes the nodes from ``depth`` on: once for each node and ancestor."""
        size = len(self.path)
        if depth >= size or size < 2:
            return
        node = np.arange(max(depth, 1), size)
        n, a = np.nonzero(np.arange(size)[None, :] < node[:, None])
        n = node[n]
        p, p0, q, q0 = self.p[n], self.p0[n], self.p[a], self.p0[a]
        value = _apart(p, q) - _apart(p, q0) - _apart(p0, q) + _apart(p0, q0)
        value *= np.array(self.through, dtype=np.int64)[n]
        self.closed.append(((self.at[a] << 32) | self.at[n], value))
        self.pending += len(value)

    def take(self) -> tuple[list[str], list[str], np.ndarray]:
        """Corrections by pair of sources so far."""
        if not self.closed:
            return [], [], np.zeros(0, dtype=np.int64)
        code = np.concatenate([c for c, _ in self.closed])
        value = np.concatenate([v for _, v in self.closed])
        pairs, which = np.unique(code, return_inverse=True)
        total = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(total, which, value)
        names = list(self.sources)
        self.closed, self.pending = [], 0
        return [names[c >> 32] for c in pairs], [names[c & 0xFFFFFFFF] for c in pairs], total


def _tree_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections (lang, a, b, value) of the rows (lang, items, times), which come sorted."""
    lang, tree = None, Tree()

    def out() -> pa.RecordBatch:
        a, b, value = tree.take()
        columns = [pa.repeat(pa.scalar(lang, pa.string()), len(a)), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    for batch in batches:
        for of, items, times in zip(*(batch.column(c) for c in ("lang", "items", "times")), strict=True):
            of = of.as_py()
            if of != lang:
                tree.leave(0)
                if tree.pending:
                    yield out()
                lang, tree = of, Tree()
            tree.insert([tuple(x.values()) for x in items.as_py()], times.as_py())
            if tree.pending > 1 << 20:
                yield out()
    tree.leave(0)
    if tree.pending:
        yield out()


def both_have(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value), a before b: corrections for the terms that both sources have.

    ``rows``: (lang, term, source, n, p, p0). Equal rows of the tree are one before they
    are dealt by range, so no range holds a hot key; ranges cut the tree, which splits
    the multiplicity of the nodes on the cut and no sum.
    """
    items = F.sort_array(F.collect_list(F.struct("source", "n", "p", "p0"))).alias("items")
    paths = rows.groupBy("lang", "term").agg(items).groupBy("lang", "items").agg(F.count(F.lit(1)).alias("times"))
    # Dealt by how a row begins: bounds of ranges are sampled, and a whole row can be long.
    begin = F.transform(F.slice("items", 1, 4), lambda x: F.struct(x["source"], x["n"]))
    ordered = paths.filter(F.size("items") > 1).repartitionByRange("lang", begin).sortWithinPartitions("lang", "items")
    found = ordered.transform(map_batches, _tree_task, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, first: int = FIRST) -> DataFrame:
    """Part ``pair``: each other source of the language and the divergence from it. Part
    ``term``: the ``first`` terms a source uses most beyond its language.

    Null text, lang and source are empty. Each row is a document, repeated rows included.
    A source without terms has its pairs, with value 0 if its language keeps no term.
    Equal values go by item in byte order. Texts of any length are read whole, in blocks.
    An empty table gives no rows. Further columns are not looked at.
    """
    terms = stored(kept_terms(docs, min_documents), "terms")
    groups = stored(sizes(docs, terms), "sources")
    one = groups.select(*(F.col(c).alias(f"g_{c}") for c in groups.columns))
    each = terms.select("lang", "term", "total", F.explode("items").alias("x")).select("lang", "term", "total", "x.*")
    rows = each.join(one, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source"))).select(
        "lang", "term", "source", "n", _share(F.col("n"), F.col("g_z")).alias("p"), F.col("g_p0").alias("p0"),
        _share(F.col("total"), F.col("g_z_lang")).alias("q"),
    )
    value = F.col("value")

    other = groups.select(*(F.col(c).alias(f"o_{c}") for c in groups.columns))
    apart = (F.col("g_lang") == F.col("o_lang")) & (F.col("g_source") != F.col("o_source"))
    base = one.join(other, apart).select(
        F.col("g_lang").alias("lang"), F.col("g_source").alias("source"), F.col("o_source").alias("item"),
        (F.col("g_v") * distance(F.col("g_p0"), F.col("o_p0"))).alias("value"),
    )
    shares = rows.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
    alone = (
        shares.join(other, (F.col("lang") == F.col("o_lang")) & (F.col("source") != F.col("o_source")))
        .select(
            "lang", "source", F.col("o_source").alias("item"),
            (F.col("times") * (distance(F.col("p"), F.col("o_p0")) - distance(F.col("p0"), F.col("o_p0")))).alias("value"),
        )
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    tree = both_have(rows).select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    # Both ways, as the divergence is the same from either source.
    halves = stored(alone.unionByName(tree), "corrections")
    turned = halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    by_value = Window.partitionBy("lang", "source").orderBy(value.desc(), "item")
    pairs = (
        base.unionByName(halves)
        .unionByName(turned)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    )
    over = rows.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        distance(F.col("p"), F.col("q")).alias("value"),
    )
    firsts = over.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= first)
    return pairs.unionByName(firsts)
