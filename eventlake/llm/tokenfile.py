"""Token counts by scanning flat token files for the end-of-document identifier.

A flat file is token identifiers in a row, each document closed by an end identifier;
nothing says where documents begin. Blocks of a file are scanned on their own, whatever
they cut through: each gives the places of its end identifiers. A prefix scan over the
blocks of a file (how many ends, and where the last one was) stitches the documents that
reach over block borders.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import file_system, map_batches, stored, text_or_empty
from eventlake.sources.scratch import scratch_path

#: End of document in the 50k byte-level vocabulary, an identifier no text encodes to.
END = 50256
TYPE = np.dtype("<u2")

_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The vocabulary of a file of ranks, once per worker process."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[path]


def _write_task(folder: str, tokenizer: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(tokenizer).encode_ordinary
        store, root = file_system(folder)
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        out, path, files, written, ordinal = None, "", 0, 0, 0
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]

        def rows(got):
            columns = zip(zip(*got, strict=True), types, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in columns], ["file", "ordinal", "doc_id", "bytes"]
            )

        for batch in batches:
            got = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    path = f"{folder}/{name}-{files:04d}.tokens"
                    out = store.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
                    files, written, ordinal = files + 1, 0, 0
                ids = np.array([*encode(text.as_py()), END], dtype=TYPE)
                out.write(ids.tobytes())
                written += ids.nbytes
                got.append((path, ordinal, doc_id, None))
                ordinal += 1
                if written >= file_bytes:
                    out.close()
                    got.append((path, None, None, written))
                    out = None
            if got:
                yield rows(got)
        if out is not None:
            out.close()
            yield rows([(path, None, None, written)])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, file_bytes: int = 256 << 20) -> DataFrame:
    """Writes flat token files below ``folder`` (shared).

    Returns what was written: a row per document with its place in its file
    (``ordinal``), and a row per file with its ``bytes``. Files of failed attempts are
    not in it.
    """
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    task = _write_task(folder, tokenizer, file_bytes)
    return stored(rows.transform(map_batches, task, "file string, ordinal long, doc_id long, bytes long"), "tokens")


def _scan_task(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, path = file_system(uri)
                with store.open_input_file(path) as file:
                    file.seek(start * TYPE.itemsize)
                    ids = np.frombuffer(file.read((stop - start) * TYPE.itemsize), dtype=TYPE)
                ends = start + np.flatnonzero(ids == end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), pa.array([start], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    ["file", "start", "ends"],
                )

    return run


def scan_files(files: DataFrame, end: int = END, block: int = 1 << 22) -> DataFrame:
    """(file, ordinal, start, n_tokens) of each document in flat files (file, bytes).

    ``start`` is the place of its first token, ``n_tokens`` leaves out the end. Tokens
    behind the last end are a document without one and get a row too.
    """
    size = F.floor(F.col("bytes") / TYPE.itemsize)
    starts = F.sequence(F.lit(0).cast("long"), size - 1, F.lit(block).cast("long"))
    blocks = files.filter("bytes > 0").select("file", F.explode(starts).alias("start"), size.alias("size"))
    blocks = blocks.select("file", "start", F.least(F.col("start") + block, F.col("size")).alias("stop"))
    found = stored(
        blocks.repartition("file", "start").transform(map_batches, _scan_task(end), "file string, start long, ends array<long>"),
        "ends",
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "file", "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ordinal"),
        (F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)) + 1).alias("carry"),
    )
    documents = F.transform(
        "ends",
        lambda at, k: F.struct(
            (F.col("ordinal") + k).alias("ordinal"),
            F.coalesce(F.get("ends", k - 1) + 1, F.col("carry")).alias("start"),
            at.alias("end"),
        ),
    )
    whole = stitched.select("file", F.explode(documents).alias("d")).select(
        "file", "d.ordinal", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens")
    )
    last = found.groupBy("file").agg(
        F.sum(F.size("ends")).alias("ordinal"), F.coalesce(F.max(F.array_max("ends")), F.lit(-1)).alias("last")
    )
    open_end = files.filter("bytes > 0").select("file", size.alias("size")).join(last, "file").select(
        "file", "ordinal", (F.col("last") + 1).alias("start"), (F.col("size") - F.col("last") - 1).alias("n_tokens")
    )
    return whole.unionByName(open_end.filter("n_tokens > 0"))


def counted(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, found in flat files written before.

    A null or empty text has no tokens, only an end. Null and repeated doc_ids are kept,
    each with its own count. An empty table gives no rows. Further columns are not
    looked at.
    """
    written = write_tokens(docs, scratch_path(spark, "tokens"), tokenizer)
    found = scan_files(written.filter("ordinal IS NULL").select("file", "bytes"))
    return written.filter("ordinal IS NOT NULL").join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
