"""WARC archives compressed with Zstandard and a shared dictionary.

An archive begins with a skippable frame that holds the dictionary; each record
after it is a frame of its own, so that a reader can start at any record.
Archives are rows (archive, content) of a table, written and committed by Spark,
and can be copied to files or read from files with any number of tasks.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replygauge.llm.common import written

#: Magic number of the skippable frame that carries a dictionary (fixed value of the format).
DICTIONARY_FRAME = 0x184D2A5D
#: Compressed bytes after which a new archive begins.
ARCHIVE_BYTES = 8 << 20
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"

RECORDS = (
    "page_id long, record_type string, refers_to long, target_uri string, payload binary, "
    "payload_bytes long, payload_digest string, record_id string"
)


def train_dictionary(samples: list[bytes], size: int = 32 << 10) -> bytes:
    """A dictionary from a bounded sample of payloads; empty if there is too little to learn from."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def archive_head(dictionary: bytes) -> bytes:
    """The leading skippable frame; the dictionary in it is itself one compressed frame."""
    if not dictionary:
        return b""
    body = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(body)) + body


def record_bytes(page_id: int | None, url: str | None, kind: str, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit carries no payload, but the length and digest of the one it repeats."""
    body = payload if kind == "response" else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def parse_record(data: bytes) -> dict:
    """Check one record and take it apart; anything unsound is a ValueError."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a colon: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields)
    if missing:
        raise ValueError(f"missing headers: {sorted(missing)}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length} does not fit a block of {len(rest) - 4} bytes")
    body, kind = rest[:length], fields["warc-type"]
    digest, size = fields.get("warc-payload-digest", "").removeprefix("sha1:"), int(fields.get("x-payload-length", length))
    if kind == "response":
        if size != length or hashlib.sha1(body).hexdigest() != digest:
            raise ValueError("the payload does not have the stated length and digest")
    elif kind != "revisit":
        raise ValueError(f"unknown record type {kind!r}")
    page, target = fields.get("x-page-id"), fields.get("x-refers-to-page")
    return {
        "page_id": None if page is None else int(page), "record_type": kind, "refers_to": None if target is None else int(target),
        "target_uri": fields.get("warc-target-uri", ""), "payload": body, "payload_bytes": size, "payload_digest": digest,
        "record_id": fields["warc-record-id"],
    }


def read_archive(content: bytes) -> Iterator[dict]:
    """All records of one archive, one frame at a time."""
    view = memoryview(content)
    at, dictionary = 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", view, 4)[0]
        body = bytes(view[8 : 8 + size])
        if len(body) != size:
            raise ValueError("the dictionary frame is cut off")
        if body[:4] == _ZSTD_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body, allow_extra_data=False)
        dictionary = zstandard.ZstdCompressionDict(body)
        at = 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        frame = decompressor.decompressobj()
        pieces, step = [], 1 << 16
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the last frame is cut off")
            pieces.append(frame.decompress(view[at : at + step]))
            at += min(step, len(view) - at)
        at -= len(frame.unused_data)
        yield parse_record(b"".join(pieces))


def with_record_types(pages: DataFrame, shortest: int = 1000) -> DataFrame:
    """Adds payload digest and length, record type, and what a revisit refers to.

    Equal payloads of at least ``shortest`` bytes: the largest page_id is the
    response. Only payloads that occur twice or more reach the join.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("payload_digest", F.sha1(F.col("html").cast("binary"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    large = rows.where(F.col("payload_bytes") >= shortest)
    repeated = (
        large.groupBy("payload_digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where(F.col("n") > 1).select("payload_digest", "first_id")
    )
    repeated = written(repeated, "warc-repeated")
    again = F.col("first_id").isNotNull() & (F.col("payload_bytes") >= shortest) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest", "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, dictionary: bytes) -> DataFrame:
    """Pages with record types as a table (archive, records, content) in the shared work folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=shared)
        head = archive_head(dictionary)
        pieces, size, count = [head], len(head), 0
        for batch in batches:
            for row in batch.to_pylist():
                payload = row["html"].encode("utf-8", "surrogatepass")
                frame = compressor.compress(record_bytes(
                    row["page_id"], row["url"], row["record_type"], payload, row["payload_bytes"], row["payload_digest"], row["refers_to"]
                ))
                pieces.append(frame)
                size += len(frame)
                count += 1
                if size >= ARCHIVE_BYTES:
                    yield archive(pieces, count)
                    pieces, size, count = [head], len(head), 0
        if count:
            yield archive(pieces, count)

    def archive(pieces: list[bytes], count: int) -> pa.RecordBatch:
        content = b"".join(pieces)
        name = f"{hashlib.sha1(content).hexdigest()}.warc.zst"
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count]), pa.array([content], pa.binary())], ["archive", "records", "content"])

    return written(pages.mapInArrow(run, "archive string, records long, content binary"), "warc")


def read_archives(archives: DataFrame, content: str | Column = "content", payloads: bool = True) -> DataFrame:
    """The records of all archives. ``payloads=False`` checks payloads but does not return them.

    For files, pass ``spark.read.format("binaryFile").load(path)``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch[0]:
                rows = []
                for record in read_archive(content.as_buffer()):
                    rows.append(record if payloads else record | {"payload": None})
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return archives.select(content).mapInArrow(run, RECORDS)


def roundtrip(pages: DataFrame, sample: int = 300) -> DataFrame:
    """Write all pages to archives with a dictionary from about ``sample`` pages, and read the records back.

    A null html is an empty payload, a null url an empty target, a null page_id a
    record without one. An empty table gives no archive and no record. Rows that
    repeat a page_id are records of their own; of equal payloads under the same,
    largest page_id each is a response.
    """
    count = max(1, pages.count())
    chance = F.pmod(F.xxhash64("page_id", F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / count))
    # the start of a page is where pages of a corpus are alike
    samples = [bytes(r[0]) for r in pages.where(chance).select(F.substring(F.col("html").cast("binary"), 1, 8192)).collect() if r[0]]
    return read_archives(write_archives(with_record_types(pages), train_dictionary(samples)), payloads=False)


def save_files(spark: SparkSession, archives: DataFrame, folder: str) -> None:
    """Copy archives to files of a folder that all executors reach as a local or mounted path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        for batch in batches:
            for name, content in zip(batch["archive"].to_pylist(), batch["content"], strict=True):
                with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(content.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array([name])], ["archive"])

    archives.select("archive", "content").mapInArrow(run, "archive string").count()


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_id", pa.string()),
])
