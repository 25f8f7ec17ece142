"""WARC archives compressed record by record with an embedded Zstandard dictionary.

Each archive starts with a skippable frame that holds the dictionary built from its own records; every
record is a frame of its own, so that one can be read alone. Copies of a payload become revisit
records. A task writes its archives below a new name and lists them in a manifest; only what the
manifest lists counts, so that lost or repeated tasks leave no trace in the result.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, staged, text_or_empty
from tillwatch.session import shared_path

# Of the WARC 1.1 standard and of its Zstandard compression.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_MAGIC = 0x184D2A5D
TRAINED_MAGIC = 0xEC30A437
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

ARCHIVE_BYTES = 16 << 20
"""Uncompressed records held for one archive; a longer record has an archive of its own."""
DICTIONARY_BYTES = 48 << 10
LEAST_DICTIONARY = 1 << 10
DICTIONARY_SHARE = 32
PIECE_BYTES = 16 << 10
READ_BYTES = 1 << 20


def _header_safe(url: str) -> str:
    return re.sub(
        r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8")), url
    )


def record(row: dict, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response."""
    page, digest, refers = row["id"], row["digest"], row["refers"]
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr(page))}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(row["size"])),
    ]
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _header_safe(row["url"])))
    if refers is None:
        block = HTTP_HEAD % row["size"] + row["payload"]
        fields.append(("Content-Type", "application/http; msgtype=response"))
    else:
        block = b""
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr(refers))}>"),
            ("X-Refers-To-Page", str(refers)),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in fields)])
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (of a revisit: empty)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on samples of the whole archive, or their raw bytes where there are too few to train on.

    The dictionary takes a share of the archive's size, ``DICTIONARY_BYTES`` at most. Records are cut into pieces
    and a piece is a sample if its checksum falls into the share that a hundred dictionaries make up.
    """
    total = sum(map(len, records))
    size = min(DICTIONARY_BYTES, max(LEAST_DICTIONARY, total // DICTIONARY_SHARE))
    every = max(1, total // (100 * size))
    pieces = [data[at : at + PIECE_BYTES] for data in records for at in range(0, len(data), PIECE_BYTES)]
    samples = [p for p in pieces if zlib.crc32(p) % every == 0] or pieces[:1]
    if len(samples) >= 20:
        try:
            return zstandard.train_dictionary(size, samples)
        except zstandard.ZstdError:
            pass  # the samples are too alike or too short
    raw = b"".join(samples)[:size]
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes], level: int = 3) -> Iterator[bytes]:
    """The archive: the dictionary in a skippable frame, then a frame for each record."""
    dictionary = build_dictionary(records)
    content = dictionary.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    for data in records:
        yield compressor.compress(data)


def _open_dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    trained = content[:4] == struct.pack("<I", TRAINED_MAGIC)
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(content, dict_type=kind)


def read_archive(file) -> Iterator[bytes]:
    """Records of an archive, one after the other; memory is bounded by the longest."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    decompressor = zstandard.ZstdDecompressor(dict_data=_open_dictionary(file.read(size)))
    held = b""
    while True:
        held = held or file.read(READ_BYTES)
        if not held:
            return
        frame, out = decompressor.decompressobj(), []
        while True:
            out.append(frame.decompress(held))
            if frame.eof:
                held = frame.unused_data
                break
            held = file.read(READ_BYTES)
            if not held:
                raise ValueError("the archive ends inside a record")
        yield b"".join(out)


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 100,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per page; returns the manifest: ``archive``, ``n_records``, ``n_bytes``.

    Of equal payloads of ``least_bytes`` or more, the record with the smallest id is a response and the
    others are revisits. A null payload is empty, a null url has no target field. Rows without id are
    responses. A repeated row (same id, same payload) is written twice with the same type. An empty
    table writes no archive. Further columns are not read. ``folder`` must be a folder all executors
    share (default: below ``spark.checkpoint.dir``).
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(text_or_empty(payload_col), "utf-8").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    copies = (
        rows.where((F.col("size") >= least_bytes) & F.col("id").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    # Only ids of copies meet their digest; payloads are shuffled once, each by its own page.
    marked = rows.join(staged(copies, "warc-copies"), "digest", "left").select(
        "id",
        "url",
        "digest",
        "size",
        F.when(F.col("id") != F.col("first"), F.col("first")).alias("refers"),
        F.when(F.col("first").isNull() | F.col("id").isNull() | (F.col("id") == F.col("first")), F.col("payload")).alias(
            "payload"
        ),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            name = f"part-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/{name}") as out:
                for piece in archive_bytes(held):
                    out.write(piece)
            done = [[f"{folder}/{name}"], [len(held)], [sum(map(len, held))]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(done[0], pa.string()), *(pa.array(x, pa.int64()) for x in done[1:])],
                names=["archive", "n_records", "n_bytes"],
            )

        size = 0
        for batch in batches:
            for at in range(batch.num_rows):  # one row at a time: payloads may be long
                data = record({k: batch.column(k)[at].as_py() for k in batch.schema.names}, date)
                if held and size + len(data) > ARCHIVE_BYTES:
                    yield close()
                    size = 0
                held.append(data)
                size += len(data)
        if held:
            yield close()

    return staged(
        marked.mapInArrow(run, "archive string, n_records long, n_bytes long"), "warc-manifest"
    )


def read_archives(manifest: DataFrame) -> DataFrame:
    """Records of the listed archives: ``page_id``, ``url``, ``record_type``, ``refers_to``,
    ``payload_bytes``, ``payload_digest`` and ``payload`` (binary, null for revisits).

    Length and digest of a response are those of the payload read, and differ from its header only in a
    damaged archive, which fails the job. The url comes back percent-encoded.
    """
    kinds = {
        "page_id": pa.int64(),
        "url": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.int64(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "payload": pa.binary(),
    }

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                store, inner = pafs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(inner) as file:
                    for data in read_archive(file):
                        fields, payload = parse_record(data)
                        stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and hashlib.sha256(payload).hexdigest() != stated:
                            raise ValueError(f"{path}: a payload does not match its digest")
                        page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
                        rows.append(
                            (
                                None if page is None else int(page),
                                fields.get("WARC-Target-URI"),
                                fields["WARC-Type"],
                                None if refers is None else int(refers),
                                int(fields["X-Payload-Length"]) if revisit else len(payload),
                                stated,
                                None if revisit else payload,
                            )
                        )
                        size += len(data)
                        if size > READ_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary"
    )
    listed = manifest.select("archive").repartition(part_count(manifest.sparkSession), "archive")
    return listed.mapInArrow(run, schema)
