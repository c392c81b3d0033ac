"""Benchmark decontamination by edit distance.

A test item with an error budget of k is split into k + 1 pieces. A passage within k
edits of it holds at least one piece unchanged (pigeonhole), so an Aho-Corasick
automaton over all pieces finds the places to look at, and Myers' bit-parallel distance
decides. Items come in blocks of bounded size, and every document is held against
every block; no document is shuffled.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import map_batches, stored, text_or_empty


@dataclass(frozen=True)
class Budget:
    """``error_rate``: edits allowed per character of an item. ``min_piece``: no piece
    is shorter, so short items get a smaller budget. ``min_item``: shorter items have
    to occur unchanged and as whole words."""

    error_rate: float = 0.08
    min_piece: int = 12
    min_item: int = 24

    def edits(self, length: int) -> int:
        return max(0, min(int(self.error_rate * length), length // self.min_piece - 1))


#: Bytes of items in a block: what is broadcast and held in memory at once.
BLOCK_BYTES = 4 << 20


def lower(text: str) -> str:
    """Lower case, one character for each character."""
    small = text.lower()
    if len(small) == len(text):
        return small
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normal(text: str) -> str:
    """Lower case, and one space for each run of white space."""
    return " ".join(lower(text).split())


def original_places(text: str) -> list[int]:
    """For each character of ``normal(text)``, its place in ``text``."""
    places: list[int] = []
    for m in re.finditer(r"\S+", text):
        if places:
            places.append(m.start() - 1)
        places.extend(range(m.start(), m.end()))
    return places


#: Letters of scripts that put no spaces between words: Thai to Lao, Myanmar, Khmer, CJK.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word goes on over either end of a passage."""

    def inside(i: int) -> bool:
        pair = text[i - 1 : i + 1] if i else ""
        return len(pair) == 2 and pair.isalnum() and not _UNSPACED.search(pair)

    return not inside(start) and not inside(end)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length with their places."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any passage of ``text``, and the end of the
    first passage that has it (0 if the empty one has)."""
    size, last = len(item), 1 << len(item) - 1
    full = (1 << size) - 1
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, score = full, 0, size
    best, end = size, 0
    for j, c in enumerate(text, 1):
        equal = at.get(c, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(across | plus) & full
        down = plus & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], budget: Budget):
        self.items = [(i, t, budget.edits(len(t)) if len(t) >= budget.min_item else 0) for i, t in items]
        self.min_item = budget.min_item
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, edits) in enumerate(self.items):
            for offset, piece in pieces(text, edits):
                places.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) in the normalised text: for each item its
        nearest passage within the budget, the first of equally near ones."""
        if self.empty:
            return []
        windows: dict[int, list[list[int]]] = {}
        short: dict[int, int] = {}
        for end, (length, where) in self.automaton.iter(text):
            for n, offset in where:
                _, item, edits = self.items[n]
                if len(item) < self.min_item:
                    if n not in short and whole_words(text, end + 1 - length, end + 1):
                        short[n] = end + 1
                    continue
                low = end + 1 - length - offset - edits
                high = low + len(item) + 2 * edits
                spans = windows.setdefault(n, [])
                if spans and low <= spans[-1][1]:
                    spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
                else:
                    spans.append([low, high])
        found = [(self.items[n][0], 0, end - len(self.items[n][1]), end) for n, end in sorted(short.items())]
        for n, spans in sorted(windows.items()):
            number, item, edits = self.items[n]
            best = None
            for low, high in spans:
                if low + edits >= 0 and text.startswith(item, low + edits):
                    best = (0, low + edits, low + edits + len(item))
                    break
                low, high = max(0, low), min(len(text), high)
                distance, end = myers(item, text[low:high])
                if distance <= edits and (best is None or distance < best[0]):
                    head = text[max(low, low + end - len(item) - edits) : low + end]
                    start = low + end - myers_start(item, head, distance)
                    best = (distance, start, low + end)
            if best:
                found.append((number, *best))
        return found


def myers_start(item: str, head: str, distance: int) -> int:
    """How far before the end of ``head`` the passage begins that ends there."""
    for tried in sorted(range(len(head) + 1), key=lambda x: abs(x - len(item))):
        if abs(tried - len(item)) > distance:
            break
        part = head[len(head) - tried :]
        if edit_distance(item, part) == distance:
            return tried
    return len(head)


def edit_distance(a: str, b: str) -> int:
    """Distance of two whole strings, bit-parallel as well."""
    if not a:
        return len(b)
    size, last = len(a), 1 << len(a) - 1
    full = (1 << size) - 1
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, score = full, 0, size
    for c in b:
        equal = at.get(c, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(across | plus) & full
        down = plus & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = (up << 1 | 1) & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
    return score


_MATCHERS: dict[str, Matcher] = {}


def _search(name: str, items, budget: Budget):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MATCHERS:  # built once per worker and block
            _MATCHERS.clear()
            _MATCHERS[name] = Matcher(items.value, budget)
        matcher = _MATCHERS[name]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                found = matcher.matches(normal(text))
                if found:
                    at = [*original_places(text), len(text)]
                    rows += [(doc_id, i, d, at[s], at[e - 1] + 1) for i, d, s, e in found]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "item_id", "distance", "start", "end"],
            )

    return run


def blocks(items: DataFrame, budget: Budget, size: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of about ``size`` bytes; only one is held at a time.

    Items without any text match nothing; their number is logged.
    """
    block: list[tuple[int, str]] = []
    held = empty = 0
    for row in items.select("item_id", "text").toLocalIterator():
        text = normal(row.text or "")
        if not text:
            empty += 1
        else:
            block.append((row.item_id, text))
            held += len(text.encode()) + 100
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block
    if empty:
        logging.getLogger(__name__).warning("%d benchmark items have no text", empty)


def leaks(
    docs: DataFrame, items: DataFrame, budget: Budget = Budget(), block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, item_id, distance, start, end): one row for each document row and item
    for which the whole text holds a passage within the item's budget.

    ``start`` and ``end`` are code points in the text. Of several passages the nearest
    counts, then the first. Null and empty texts and items match nothing. Null ids stay
    null, repeated rows give repeated results, and an empty table on either side gives
    no rows. Further columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    )
    schema = "doc_id long, item_id long, distance long, start long, end long"
    found = spark.createDataFrame([], schema)
    for block in blocks(items, budget, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        name = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
        found = found.union(stored(rows.transform(map_batches, _search(name, shared, budget), schema), "leaks"))
        shared.unpersist()
    return found


def decontaminate(
    docs: DataFrame, items: DataFrame, budget: Budget = Budget(), block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without those that hold an item, columns unchanged.

    One pass per block of items over what is left; nothing is shuffled, and every row is
    judged by itself.
    """
    spark = docs.sparkSession
    for block in blocks(items, budget, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        name = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
        docs = docs.transform(map_batches, _keep_clean(name, shared, budget), docs.schema)
    return docs


def _keep_clean(name: str, items, budget: Budget):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[name] = Matcher(items.value, budget)
        matcher = _MATCHERS[name]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            clean = [not (t.is_valid and matcher.matches(normal(t.as_py()))) for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
