"""WARC archives: round trip, revisits, and the archive format itself."""

from __future__ import annotations

import hashlib
import io
import struct

import zstandard

from tests.llm.conftest import by_id
from tillwatch.llm import warc
from tillwatch.llm.queries import QUERIES


def expected(pages):
    first = {}
    for page, html in pages:
        if page is not None:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, html in pages:
        data = (html or "").encode()
        copy = len(data) >= 100 and page is not None and first[html] != page
        out.append(
            (page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if copy else "response", first[html] if copy else None)
        )
    return sorted(out, key=repr)


def test_rows_of_every_kind(spark):
    long_html = "<p>" + "long \u00e9 " * 200_000
    pages = [
        (5, "a" * 100), (3, "a" * 100), (4, "a" * 99), (2, "a" * 99), (1, None), (6, ""), (7, long_html), (8, long_html),
        (9, "\r\n\r\nWARC/1.1\r\n" * 20), (None, "a" * 100), (None, None), (10, "x" * 150), (10, "x" * 150),
    ]
    rows = [(p, f"http://x/\r\n {p} \u00e9" if p else None, h, "clash") for p, h in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(4)
    manifest = warc.write_archives(df)
    back = warc.read_archives(manifest)
    got = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back.collect()
    ]
    assert sorted(got, key=repr) == expected(pages)
    payloads = {r["page_id"]: r["payload"] for r in back.collect() if r["record_type"] == "response"}
    assert bytes(payloads[7]).decode() == long_html
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(pages)
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_archive_layout():
    records = [warc.record(
        {"id": i, "url": f"http://x/{i}", "payload": b"<html>%d</html>" % i * 9, "size": 9 * len(b"<html>%d</html>" % i),
         "digest": "d", "refers": None}, "2024-01-01T00:00:00Z") for i in range(300)]
    data = b"".join(warc.archive_bytes(records))
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert frame.decompress(data[8 + size :]) == records[0]  # each record is a frame of its own
    assert list(warc.read_archive(io.BytesIO(data))) == records
    assert len(data) < sum(map(len, records)) / 3
    few = b"".join(warc.archive_bytes(records[:2]))
    assert list(warc.read_archive(io.BytesIO(few))) == records[:2]


def test_registered_query(spark, sf_dir):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = by_id(QUERIES["op4_warc"](spark, sf_dir), "page_id")
    assert sorted((tuple(r.values()) for r in got.values()), key=repr) == expected(pages)
