"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress by themselves. Behind the frames, in
skippable frames that any Zstandard reader passes over, lie a directory of record
identifiers (frame, place in the frame, length) and a seek table of frame sizes in the
published seekable format. Any record can be read by two small reads and one frame.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.shared import file_system, map_batches, stored
from eventlake.sources.scratch import scratch_path

#: Fixed values of the seekable format: magic numbers of skippable frames and the footer.
SEEK_MAGIC = 0x184D2A5E
DIRECTORY_MAGIC = 0x184D2A5D
FOOTER_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(row: dict) -> bytes:
    """One WARC record. A revisit has the HTTP header of its payload, not the payload."""
    payload = row["payload"]
    revisit = row["record_type"] == "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", row["date"]),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["url"] is not None:
        headers.append(("WARC-Target-URI", " ".join(row["url"].split())))
    if row["page_id"] is not None:
        headers.append(("X-Page-ID", str(row["page_id"])))
    if revisit:
        headers += [("WARC-Profile", REVISIT), ("X-Refers-To-Page-ID", str(row["refers_to"]))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``start``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", start)
    version, *lines = data[start:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record at {start}: {version[:20]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {start} has no end")
    return headers, data[begin:stop], stop + 4


class Bundle:
    """Writes one bundle; holds one frame and the directory in memory."""

    def __init__(self, out, frame_bytes: int, level: int = 3):
        self.out, self.frame_bytes = out, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.frame = bytearray()
        self.sizes: list[tuple[int, int]] = []
        self.directory: list[tuple[str, int, int, int]] = []
        self.written = 0

    def add(self, record_id: str, data: bytes) -> None:
        if self.frame and len(self.frame) + len(data) > self.frame_bytes:
            self._close_frame()
        self.directory.append((record_id, len(self.sizes), len(self.frame), len(data)))
        self.frame += data
        self.written += len(data)

    def _close_frame(self) -> None:
        packed = self.compress(bytes(self.frame))
        self.out.write(packed)
        self.sizes.append((len(packed), len(self.frame)))
        self.frame = bytearray()

    def close(self) -> None:
        if self.frame:
            self._close_frame()
        listed = self.compress(json.dumps(self.directory).encode())
        self.out.write(struct.pack("<II", DIRECTORY_MAGIC, len(listed) + 8) + listed)
        self.out.write(struct.pack("<Q", len(listed)))  # so that it can be found from the end
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += FOOTER.pack(len(self.sizes), 0, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to a bundle."""

    def __init__(self, uri: str):
        store, path = file_system(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        count, _, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != FOOTER_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        self.table_at = size - FOOTER.size - 8 * count - 8
        table = self._at(self.table_at + 8, 8 * count)
        self.frames, place = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", table, 8 * i)
            self.frames.append((place, packed, plain))
            place += packed

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def frame(self, n: int) -> bytes:
        place, packed, plain = self.frames[n]
        return zstandard.ZstdDecompressor().decompress(self._at(place, packed), max_output_size=plain)

    def directory(self) -> dict[str, tuple[int, int, int]]:
        """record id -> (frame, place in the frame, length)"""
        (size,) = struct.unpack("<Q", self._at(self.table_at - 8, 8))
        listed = zstandard.ZstdDecompressor().decompress(self._at(self.table_at - 8 - size, size))
        return {r: (f, p, n) for r, f, p, n in json.loads(listed)}

    def read(self, record_id: str) -> tuple[dict[str, str], bytes]:
        frame, place, _ = self.directory()[record_id]
        headers, block, _ = parse(self.frame(frame), place)
        return headers, block

    def close(self) -> None:
        self.file.close()


NAMESPACE = uuid.UUID("5c1b2f2e-6b1f-4a58-9d3a-0d2b8a3f6f10")


def _write_task(folder: str, date: str, frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        task = TaskContext.get()
        # An attempt of its own name: a second attempt never meets the first one's files.
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        bundle, path, done, n = None, "", [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {k: batch.column(k)[at].as_py() for k in batch.schema.names}
                if bundle is None:
                    path = f"{name}-{len(done):04d}.warc.zst"
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                    bundle = Bundle(out, frame_bytes)
                row["record_id"] = f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{name}/{n}')}"
                row["date"] = date
                n += 1
                bundle.add(row["record_id"], record(row))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    done.append((path, len(bundle.directory), len(bundle.sizes)))
                    bundle = None
        if bundle is not None:
            bundle.close()
            done.append((path, len(bundle.directory), len(bundle.sizes)))
        if done:
            paths, records, frames = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{p}" for p in paths]), pa.array(records, pa.int64()), pa.array(frames, pa.int64())],
                ["bundle", "records", "frames"],
            )

    return run


def with_record_types(pages: DataFrame, least: int = 100) -> DataFrame:
    """Adds payload, its size and digest, and which records revisit another.

    Of the records with equal payloads of ``least`` bytes or more, the one with the
    smallest page_id is the response, and so are rows that repeat that page_id. Null
    ids count as largest. The smallest page_id of each digest is found by partial
    aggregation, so copies in any number are no hot group.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    large = rows.filter(F.col("payload_bytes") >= least)
    first = large.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id_"), F.count(F.lit(1)).alias("n_")
    ).filter("n_ > 1").select(F.col("payload_digest").alias("digest_"), "first_id_")
    revisit = F.col("digest_").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id_"))
    return rows.join(
        first, (rows.payload_digest == first.digest_) & (rows.payload_bytes >= least), "left"
    ).select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id_")).alias("refers_to"),
    )


def write_bundles(
    pages: DataFrame,
    folder: str,
    date: str = "2024-01-01T00:00:00Z",
    frame_bytes: int = 1 << 20,
    bundle_bytes: int = 256 << 20,
    least: int = 100,
) -> DataFrame:
    """Writes the archives below ``folder`` (shared); returns the list of bundles.

    Bundles of failed attempts are not in the list. A record longer than a frame has
    one of its own.
    """
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    task = _write_task(folder, date, frame_bytes, bundle_bytes)
    listed = with_record_types(pages, least).transform(map_batches, task, "bundle string, records long, frames long")
    return stored(listed, "bundles")


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "payload"]
    for batch in batches:
        for uri, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            reader = BundleReader(uri)
            for n in range(first, last):
                data, at, rows = reader.frame(n), 0, []
                while at < len(data):
                    headers, block, at = parse(data, at)
                    head, _, payload = block.partition(b"\r\n\r\n")
                    revisit = headers["WARC-Type"] == "revisit"
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    if not revisit and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"{uri}: {headers['WARC-Record-ID']} is damaged")
                    page, target = (headers.get(k) for k in ("X-Page-ID", "X-Refers-To-Page-ID"))
                    rows.append((
                        None if page is None else int(page), size, digest, headers["WARC-Type"],
                        None if target in (None, "None") else int(target), headers.get("WARC-Target-URI"),
                        headers["WARC-Record-ID"].strip("<>"), None if revisit else payload,
                    ))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)
            reader.close()


def read_bundles(bundles: DataFrame, frames: int = 64) -> DataFrame:
    """All records of listed bundles; a task reads ``frames`` frames at a time."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("frames") - 1, F.lit(frames).cast("long"))
    ranges = bundles.filter("frames > 0").select("bundle", F.explode(starts).alias("first"), "frames").select(
        "bundle", "first", F.least(F.col("first") + frames, F.col("frames")).alias("last")
    )
    return ranges.repartition("bundle", "first").transform(
        map_batches, _read_task,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
        " url string, record_id string, payload binary",
    )


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes all pages to archives in the shared scratch folder and reads them back:
    page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null page is an empty payload; a null page_id or url is left out of its record and
    comes back as null. Sizes and digests are those of the full payload, also for
    revisits. An empty table gives no rows. Further columns are not looked at.
    """
    bundles = write_bundles(pages, scratch_path(spark, "warc"))
    return read_bundles(bundles).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
