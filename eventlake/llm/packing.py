"""Cost-balanced packing of documents into sequences of bounded length.

Each task tokenizes its documents and packs them in groups of bounded size: no shuffle,
and no group grows with the input. In a group, full sequences are cut off first. What
is left of each document goes, by falling cost, to the cheapest sequence that has room
for it; cost is linear plus quadratic in a piece's length, as attention's is. There are
no more sequences than the tokens need, so the last pieces are cut to fill the gaps.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import map_batches, text_or_empty

END = 1
_WIDTH = 4


@dataclass(frozen=True)
class Cost:
    """Cost of a piece of n tokens: ``linear * n + quadratic * n * n``. By default the
    quadratic part overtakes the linear one at 1024 tokens."""

    linear: float = 1.0
    quadratic: float = 1 / 1024

    def of(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n


class WordEncoder:
    """Token ids of texts as little-endian 32-bit bytes, word by word.

    For tokenizers whose pieces never reach over ASCII white space: the ids of a text are
    then those of its words in a row, and words repeat. Common forms (letters, then
    punctuation) go to the model directly; everything else through the whole tokenizer.
    Both memories are bounded and start anew when full.
    """

    _SIMPLE = re.compile(r"([a-zß-öø-ÿ]+)([.,!?;:*#$%&|]*)")

    def __init__(self, path: str, words: int = 400_000, parts: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.most_words, self.most_parts = words, parts
        # The byte-level alphabet: printable bytes stand for themselves, others in
        # order for the characters from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alphabet = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(_WIDTH, "little") for i in ids)

    def _part(self, part: str, letters: bool) -> bytes:
        got = self.parts.get(part)
        if got is None:
            if letters:
                shown = "".join([self.alphabet[b] for b in part.encode()])
                tokens = self.tokenizer.model.tokenize(shown)
                got = b"".join([t.id.to_bytes(_WIDTH, "little") for t in tokens])
            else:
                got = self._whole(part)
            if len(self.parts) >= self.most_parts:
                self.parts.clear()
            self.parts[part] = got
        return got

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        small = text.lower()
        simple = self._SIMPLE.fullmatch(small) if len(small) == len(text) else None
        if simple is None:
            return self._whole(text)
        letters, rest = simple.groups()
        return self._part(letters, True) + (self._part(rest, False) if rest else b"")

    def encode(self, text: bytes) -> bytes:
        words = text.split()
        known = self.words
        for word in set(words):
            if word not in known:
                known[word] = self._word(word)
        got = b"".join([known[w] for w in words])
        if len(known) >= self.most_words:
            known.clear()
        return got


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pack(pieces: list[tuple[int, int]], room: int, cost: Cost) -> Iterator[tuple[int, int, int, int, int]]:
    """Packs pieces (document, length), length at most ``room``.

    Yields (document, start, length, sequence, offset); ``start`` counts from the
    piece's begin. Ties: the piece that came first, the sequence with the lower number.
    Lengths fall, so a sequence that is too full for one piece waits, by what it has
    left, until pieces are short enough for it.
    """
    total = sum(n for _, n in pieces)
    free = [room] * -(-total // room)
    spent = [0.0] * len(free)
    ready = [(0.0, s) for s in range(len(free))]
    waiting: list[tuple[int, int]] = []

    def put(s: int, n: int) -> int:
        offset = room - free[s]
        free[s] -= n
        spent[s] += cost.of(n)
        if free[s]:
            heapq.heappush(ready, (spent[s], s))
        return offset

    for at in sorted(range(len(pieces)), key=lambda i: (-pieces[i][1], i)):
        document, left = pieces[at]
        while waiting and -waiting[0][0] >= left:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (spent[s], s))
        while ready and free[ready[0][1]] < left:
            s = heapq.heappop(ready)[1]
            heapq.heappush(waiting, (-free[s], s))
        if ready:
            s = heapq.heappop(ready)[1]
            yield document, 0, left, s, put(s, left)
            continue
        start = 0
        while left:  # none has room for all of it: the largest gaps share it
            s = heapq.heappop(waiting)[1]
            n = min(free[s], left)
            yield document, start, n, s, put(s, n)
            start, left = start + n, left - n


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _pack_task(path: str, room: int, group: int, cost: Cost, ids: bool):
    names = [*FIELDS, *(["ids"] if ids else [])]
    types = [pa.int64()] * 7 + ([pa.binary()] if ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        rests: list[tuple] = []
        end = END.to_bytes(_WIDTH, "little")

        def row(doc_id, start, part, tokens, place, offset):
            base = (doc_id, start, len(part) // _WIDTH, zlib.crc32(part), tokens, place, offset)
            rows.append((*base, part) if ids else base)

        def flush(rests):
            nonlocal sequence
            used = -1
            for d, start, n, s, offset in pack([(i, len(r[2]) // _WIDTH) for i, r in enumerate(rests)], room, cost):
                doc_id, first, data, tokens = rests[d]
                part = data[start * _WIDTH : (start + n) * _WIDTH]
                row(doc_id, first + start, part, tokens, sequence + s, offset)
                used = max(used, s)
            sequence += used + 1

        def out():
            nonlocal rows
            got = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
            )
            rows = []
            return got

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(text.as_buffer().to_pybytes()) + end
                tokens = len(data) // _WIDTH
                full = tokens - tokens % room
                for start in range(0, full, room):
                    row(doc_id, start, data[start * _WIDTH : (start + room) * _WIDTH], tokens, sequence, 0)
                    sequence += 1
                if full < tokens:
                    rests.append((doc_id, full, data[full * _WIDTH :], tokens))
                if len(rests) >= group:
                    flush(rests)
                    rests = []
                if len(rows) >= 10_000:
                    yield out()
        flush(rests)
        if rows:
            yield out()

    return run


def packed(
    docs: DataFrame,
    tokenizer: str,
    room: int = 2048,
    group: int = 8192,
    cost: Cost = Cost(),
    ids: bool = False,
) -> DataFrame:
    """One row per piece: where it comes from, where it lies, and a checksum of its ids.

    ``tokenizer`` is the path of a tokenizer file that every executor can read. With
    ``ids`` the token ids follow as little-endian 32-bit bytes. A null or empty text
    is the end token alone. Null and repeated doc_ids are kept as they are, each row
    packed on its own. An empty table gives no rows. Further columns are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )
    schema = ", ".join([f"`{f}` long" for f in FIELDS] + (["ids binary"] if ids else []))
    return rows.transform(map_batches, _pack_task(tokenizer, room, group, cost, ids), schema)


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
