"""WARC archives: a writer that stores equal payloads once, and a reader that splits files.

Every record is a gzip member of its own. The reader gives tasks byte ranges of the files. A task scans its
range for the gzip magic, takes a candidate as a member when its first bytes decode to a record
header, and owns the records that start inside its range, reading past the range's end where the last
one does. After a good member the next is expected right behind it; where a member is broken the
scan starts again one byte further.

The writer finds, for each payload that occurs more than once, the largest page id; that page is
stored as ``response``, the others as ``revisit`` that refer to it. Payloads are grouped by their SHA-1 in
two steps, first per part of a group, so a payload that a third of all pages share is no single
task's work. Files carry the name of the attempt that wrote them and the manifest names the files, so
repeated attempts can't mix.

Defined results: a null html is an empty payload; a null id is written and read as null, refers to the
largest id of its payload, and if no page of a payload has an id all are responses; repeated rows of the
largest id are all responses; a null url has no target header; an empty table makes no files and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructType

from meterline.llm.common import as_batch, map_partitions, salt_of

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range that one task reads, and of one read.
SPLIT = 16 << 20
BLOCK = 1 << 20
#: A file is closed once it holds this many bytes.
FILE_BYTES = 256 << 20
LEVEL = 4

MANIFEST = (
    StructType().add("path", StringType()).add("bytes", LongType()).add("records", LongType())
)
RECORD = StructType().add("path", StringType()).add("offset", LongType())
for _name in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest"):
    RECORD = RECORD.add(_name, StringType())
RECORD = (
    RECORD.add("payload_bytes", LongType()).add("payload", BinaryType()).add("intact", BooleanType())
)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file that all executors can reach."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"urn:page:{page_id if page_id is not None else 'none-' + uuid.uuid4().hex}"


def record_bytes(page_id, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    response = refers_to is None
    block = http + payload if response else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response else 'revisit'}",
        f"WARC-Record-ID: <{page_urn(page_id)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if not response:
        head.append(f"WARC-Refers-To: <{page_urn(refers_to)}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(data, LEVEL, mtime=0)


class _Write:
    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(self.folder)
        schema = to_arrow_schema(MANIFEST)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, path, size, records, number = None, "", 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return as_batch({"path": [path], "bytes": [size], "records": [records]}, schema)

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to = (c[i].as_py() for c in columns)
                if out is None:
                    path, size, records = f"{folder}/{name}-{number}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                    number += 1
                data = record_bytes(page_id, url, payload or b"", refers_to)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Page id, url, payload and, for a payload seen before under a larger id, that id."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", payload.alias("html")).select(
        "page_id",
        "url",
        "html",
        F.sha1("html").alias("sha"),
        salt_of(F.struct("page_id", "url")).alias("salt"),
    )
    parts = (
        keyed.where(F.octet_length("html") >= least_bytes)
        .groupBy("sha", "salt")
        .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    originals = (
        parts.groupBy("sha")
        .agg(F.max("top").alias("top"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
        .where("n > 1 AND top IS NOT NULL")
        .select("sha", "top", F.explode("salts").alias("salt"))
    )
    first = F.col("top").isNull() | F.col("page_id").eqNullSafe(F.col("top"))
    return keyed.join(originals, ["sha", "salt"], "left").select(
        "page_id", "url", "html", F.when(~first, F.col("top")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes the pages under ``folder`` when the returned manifest is evaluated (once)."""
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    return map_partitions(with_originals(pages, least_bytes), _Write(folder), MANIFEST)


class _Source:
    """Forward reads of one file from any offset."""

    def __init__(self, store: fs.FileSystem, path: str, size: int):
        self.file, self.size = store.open_input_file(path), size

    def read(self, start: int, n: int) -> bytes:
        n = min(n, self.size - start)
        return self.file.read_at(n, start) if n > 0 else b""


def is_member(source: _Source, start: int) -> bool:
    """Whether a gzip member with a record header begins here."""
    try:
        head = zlib.decompressobj(31).decompress(source.read(start, 512), 64)
    except zlib.error:
        return False
    return head.startswith(b"WARC/")


def next_member(source: _Source, start: int, end: int) -> int | None:
    """The first member that starts in [start, end)."""
    while start < end:
        block = source.read(start, min(BLOCK, end - start) + len(MAGIC) - 1)
        at = block.find(MAGIC)
        while at >= 0:
            if is_member(source, start + at):
                return start + at
            at = block.find(MAGIC, at + 1)
        start += BLOCK
    return None


def decode_member(source: _Source, start: int) -> tuple[bytes, int] | None:
    """The member's content and the offset behind it; None if it is broken."""
    decoder, parts, at = zlib.decompressobj(31), [], start
    try:
        while not decoder.eof:
            block = source.read(at, 64 << 10)
            if not block:
                return None
            parts.append(decoder.decompress(block))
            at += len(block)
    except zlib.error:
        return None
    return b"".join(parts), at - len(decoder.unused_data)


def parse_record(data: bytes) -> dict:
    """Header fields (lower-case names) and the block of the record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    fields[""] = rest[: int(fields.get("content-length", len(rest)))]
    return fields


class _Read:
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(RECORD)
        for batch in batches:
            for split in batch.to_pylist():
                rows, held = [], 0
                for row in self.records(split):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held >= BLOCK * 8:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def records(self, split: dict) -> Iterator[dict]:
        store, path = open_store(split["path"])
        source = _Source(store, path, split["bytes"])
        start, end = split["start"], split["end"]
        at = next_member(source, start, end)
        while at is not None and at < end:
            member = decode_member(source, at)
            if member is None:
                at = next_member(source, at + 1, end)
                continue
            yield self.row(split["path"], at, parse_record(member[0]))
            at = member[1]
            if at < end and not is_member(source, at):
                at = next_member(source, at, end)

    @staticmethod
    def row(path: str, offset: int, fields: dict) -> dict:
        kind = fields.get("warc-type")
        payload = fields[""].partition(b"\r\n\r\n")[2] if kind == "response" else None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size = fields.get("x-payload-length")
        return {
            "path": path,
            "offset": offset,
            "record_type": kind,
            "record_id": fields.get("warc-record-id", "").strip("<>") or None,
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
            "payload_digest": digest,
            "payload_bytes": int(size) if size else None if payload is None else len(payload),
            "payload": payload,
            "intact": payload is None or digest is None or digest == digest_of(payload),
        }


def read_archives(files: DataFrame, split_bytes: int = SPLIT) -> DataFrame:
    """One row per record of ``files`` (path, bytes), whatever the place of the splits."""
    spark = files.sparkSession
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes)))
    splits = files.where("bytes > 0").select("path", "bytes", starts.alias("start")).withColumn(
        "end", F.least(F.col("start") + split_bytes, F.col("bytes"))
    )
    total = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).head()[0] or 1
    spread = splits.repartition(int(max(total, spark.sparkContext.defaultParallelism)))
    return map_partitions(spread, _Read(), RECORD)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives in a folder, listed by Spark."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def page_records(records: DataFrame) -> DataFrame:
    """Records of ``write_archives`` by page: ids as numbers, payload sizes and digests."""
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c)).cast("long")
    return records.select(
        as_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        as_id("refers_to").alias("refers_to"),
        "intact",
    )


