"""Words of large blocks of text as arrays: exact numbers for them, without a loop over words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Classes of bytes: part of a word, white space between words, end of a piece.
WORD, WHITE, CUT = 0, 1, 2


def byte_classes(white: bytes, cut: bytes) -> np.ndarray:
    classes = np.zeros(256, dtype=np.uint8)
    classes[list(white)] = WHITE
    classes[list(cut)] = CUT
    return classes


@dataclass(frozen=True)
class Words:
    """Words in order: where each begins, its number (equal words, equal numbers), how
    many pieces ended before it, and the words by number."""

    starts: np.ndarray
    ids: np.ndarray
    piece: np.ndarray
    names: pa.Array


def split_words(data: bytes, classes: np.ndarray) -> Words:
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = classes[raw]
    inside = kind == WORD
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    piece = np.cumsum(kind == CUT, dtype=np.int32)[starts]
    return Words(starts, coded.indices.to_numpy().astype(np.int64), piece, coded.dictionary)


def blocks(text: bytes, size: int, classes: np.ndarray, ahead: int = 0) -> Iterator[tuple[bytes, int]]:
    """Cuts a text between words into blocks of about ``size`` bytes.

    Gives each block with up to ``ahead`` further words of its last piece, and the
    length of the block itself: words that begin beyond it belong to the next one.
    """
    if len(text) <= size:
        if text:
            yield text, len(text)
        return
    word = _one_of(classes, WORD)
    gap = re.compile(b"[^" + word + b"]")
    after = re.compile(b"(?:[" + _one_of(classes, WHITE) + b"]+[" + word + b"]+){0,%d}" % ahead) if ahead else None
    start = 0
    while start < len(text):
        found = gap.search(text, min(start + size, len(text)))
        stop = found.start() if found else len(text)
        # The byte after the last word goes along, so that each block is longer than nothing.
        end = after.match(text, stop).end() if after else stop
        yield text[start:end], stop - start
        start = stop


def _one_of(classes: np.ndarray, kind: int) -> bytes:
    return b"".join(b"\\x%02x" % b for b in np.flatnonzero(classes == kind))


def gathered(
    batches: Iterable[pa.RecordBatch], size: int, work: Callable[[tuple, list[bytes]], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Gives ``work`` the texts of each key, about ``size`` bytes at a time.

    The last column of a batch is the text, as bytes; the others are the key. A longer
    text comes alone.
    """
    held: dict[tuple, list[bytes]] = {}
    total: dict[tuple, int] = {}
    for batch in batches:
        keys = zip(*(c.to_pylist() for c in batch.columns[:-1]), strict=True)
        for key, text in zip(keys, batch.columns[-1], strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            if not data:
                continue
            if len(data) > size:
                yield from work(key, [data])
                continue
            held.setdefault(key, []).append(data)
            total[key] = total.get(key, 0) + len(data)
            # Together, all keys hold no more than a few blocks.
            if total[key] > size or sum(total.values()) > 2 * size:
                most = max(total, key=total.get)
                total.pop(most)
                yield from work(most, held.pop(most))
    for key, texts in held.items():
        yield from work(key, texts)
