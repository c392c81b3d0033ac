from __future__ import annotations

import hashlib

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from eventlake.llm import warc
from eventlake.llm.catalog import QUERIES


def plain(pages):
    """(page_id, bytes, digest, type, refers_to) by hand."""
    first = {}
    for i, h in pages:
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, h in pages:
        data = (h or "").encode()
        revisit = data in first and i != first[data]
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[data] if revisit else None))
    return sorted(out, key=str)


@pytest.fixture()
def pages(spark):
    def build(rows):
        rows = [(i, f"http://h/{i}" if i != 3 else None, h, 1) for i, h in rows]
        return spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes long")

    return build


PAGES = [
    (1, None), (2, ""), (3, "é" * 50), (4, "é" * 50), (-5, "é" * 50), (6, "short"), (7, "short"), (8, "a" * 99), (9, "a" * 99),
    (10, "\r\n\r\nWARC/1.1\r\n" * 20), (11, "\r\n\r\nWARC/1.1\r\n" * 20), (12, "big " * 700_000), (None, "é" * 50), (13, "z" * 200),
    (13, "z" * 200), (14, "z" * 200),
]


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip(spark, pages):
    assert found(warc.archived(spark, pages(PAGES))) == plain(PAGES)
    assert warc.archived(spark, pages([])).count() == 0


def test_query(spark):
    rows = duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()
    assert found(QUERIES["op3_warc"](spark, "/root/testdata/sf0.001")) == plain(rows)


def test_bundles_are_seekable_and_plain_zstandard(spark, pages, folder):
    rows = [(i, f"page {i} " * 100) for i in range(200)]
    listed = warc.write_bundles(pages(rows).coalesce(1), f"file://{folder}/a", frame_bytes=20_000, bundle_bytes=60_000).collect()
    assert len(listed) > 1 and sum(b.records for b in listed) == 200 and all(b.frames > 1 for b in listed[:-1])
    seen = set()
    for b in listed:
        reader = warc.BundleReader(b.bundle)
        raw = open(b.bundle.removeprefix("file://"), "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert whole == b"".join(reader.frame(n) for n in range(len(reader.frames)))
        for record_id, (frame, place, length) in reader.directory().items():
            headers, block = reader.read(record_id)
            assert headers["WARC-Record-ID"] == f"<{record_id}>"
            assert reader.frame(frame)[place : place + length].startswith(b"WARC/1.1\r\n")
            seen.add(int(headers["X-Page-ID"]))
            assert block.endswith(rows[int(headers["X-Page-ID"])][1].encode())
    assert seen == set(range(200))


def test_a_damaged_payload_is_noticed(spark, pages, folder):
    (b,) = warc.write_bundles(pages([(1, "x" * 300)]).coalesce(1), f"file://{folder}/b").collect()
    path = b.bundle.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    data = warc.BundleReader(b.bundle).frame(0).replace(b"xxx\r\n\r\n", b"xxy\r\n\r\n")
    reader = warc.BundleReader(b.bundle)
    packed = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(data)
    size = reader.frames[0][1]
    bad = packed + bytes(raw[size:])
    at = len(bad) - warc.FOOTER.size - 8
    bad = bad[:at] + len(packed).to_bytes(4, "little") + bad[at + 4 :]
    open(path, "wb").write(bad)
    with pytest.raises(Exception, match="damaged"):
        warc.read_bundles(spark.range(1).select(F.lit(b.bundle).alias("bundle"), F.lit(1).cast("long").alias("records"), F.lit(1).cast("long").alias("frames"))).collect()
