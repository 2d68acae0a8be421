"""WARC archives: one gzip member a record, written by tasks and read back sequentially."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedloom.session import Staging

from .common import small_batches

# Payloads shorter than this are always stored.
REVISIT_FROM = 1000
# A task begins a new archive when one has this many bytes.
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 16

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]+)", re.IGNORECASE)


class WarcError(ValueError):
    """An archive whose framing is broken: no gzip member, a cut record, a wrong length."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""

    @property
    def type(self) -> str:
        return self.headers.get("warc-type", "")


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _page_urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(found.group(1)) if found else None


def record_bytes(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the payload's digest and length but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: {sha1_label(payload)}",
        f"WARC-Block-Digest: {sha1_label(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        # Only what may stand in an address, so that none breaks the header.
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_page_urn(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode("ascii") + b"\r\n\r\n"
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def members(stream: BinaryIO) -> Iterator[bytes]:
    """The contents of each gzip member in turn, decompressed as the bytes come in."""
    data = stream.read(READ_BYTES)
    while data:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                raise WarcError("the archive ends within a member")
            try:
                out.append(unpacker.decompress(data))
            except zlib.error as error:
                raise WarcError(str(error)) from error
            data = unpacker.unused_data if unpacker.eof else stream.read(READ_BYTES)
        yield b"".join(out)
        data = data or stream.read(READ_BYTES)


def _fields(head: bytes) -> dict[str, str]:
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]
    pairs = (line.partition(b":") for line in lines if line)
    return {name.strip().lower().decode("latin-1"): value.strip().decode("utf-8", "replace") for name, _, value in pairs}


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an archive, one a member, framed by Content-Length."""
    for data in members(stream):
        head, gap, rest = data.partition(b"\r\n\r\n")
        length = _LENGTH.search(head)
        if not head.startswith(b"WARC/") or not gap or not length:
            raise WarcError("no record header")
        size = int(length.group(1))
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise WarcError("the block is not as long as its header says")
        record = Record(_fields(head), rest[:size])
        if record.headers.get("content-type", "").startswith("application/http"):
            http, _, record.payload = record.block.partition(b"\r\n\r\n")
            record.http = _fields(http)
        yield record


def verified(record: Record) -> bool:
    """Whether the digests the header gives are those of the block and, unless it is a revisit, the payload."""
    block, payload = record.headers.get("warc-block-digest"), record.headers.get("warc-payload-digest")
    return (block is None or block == sha1_label(record.block)) and (
        payload is None or record.type == "revisit" or payload == sha1_label(record.payload)
    )


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to and revisit.

    Of rows with equal payloads of at least REVISIT_FROM bytes, those with the largest page_id are
    responses, all others refer to it; rows without an id refer to it too. Only digests with more
    than one page are looked up, and each body moves once at most; a digest shared by very many
    pages is split by adaptive execution, as its right row is single.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", body.alias("html")).withColumn(
        "__digest", F.when(F.octet_length("html") >= REVISIT_FROM, F.sha1("html"))
    )
    shared = (
        keyed.where(F.col("__digest").isNotNull())
        .groupBy("__digest")
        .agg(F.max("page_id").alias("__last"), F.count(F.lit(1)).alias("__n"))
        .where((F.col("__n") > 1) & F.col("__last").isNotNull())
        .drop("__n")
    )
    # Short bodies have a key of their own each, so that none of them meet.
    key = F.coalesce("__digest", F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string")))
    revisit = F.col("__last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__last"))
    return (
        keyed.withColumn("__digest", key)
        .join(shared.hint("shuffle_hash"), "__digest", "left")
        .select("page_id", "url", "html", F.when(revisit, F.col("__last")).alias("refers_to"), revisit.alias("revisit"))
    )


def write_archives(pages: DataFrame, folder: str, *, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes one record for each row and returns path, records and bytes of each archive.

    A file's name is that of one attempt of a task. The result names the files of the attempts whose
    rows Spark kept; it is to be staged before the archives are read. What a lost attempt left in
    the folder is in no list.
    """
    spark = pages.sparkSession
    small_batches(spark)
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    schema = "path string, records long, bytes long"
    fields = to_arrow_schema(StructType.fromDDL(schema))
    root = folder.rstrip("/")

    def run(batches: Iterable[pa.RecordBatch]):
        filesystem, place = fs.FileSystem.from_uri(root)
        filesystem.create_dir(place, recursive=True)
        out, name, done = None, "", []
        records = size = 0
        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out, records, size = filesystem.open_output_stream(f"{place}/{name}", compression=None), 0, 0
                    page_id, url, payload, refers_to, revisit = row
                    data = record_bytes(page_id, url, payload, refers_to, revisit, date)
                    out.write(data)
                    records, size = records + 1, size + len(data)
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        done.append((f"{root}/{name}", records, size))
        finally:
            if out is not None:
                out.close()
                done.append((f"{root}/{name}", records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], type=f.type) for i, f in enumerate(fields)], schema=fields
        )

    return with_revisits(pages).mapInArrow(run, schema)


READ = (
    "path string, page_id long, url string, record_type string, refers_to long, payload binary, "
    "payload_bytes long, payload_digest string, digest_ok boolean"
)


def read_archives(archives: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The records of the files under ``path``: one task reads whole files, record by record.

    payload_bytes and payload_digest are those of the full payload, for a revisit as its header has
    them; its payload is null. digest_ok tells whether the digests hold. Broken framing raises WarcError.
    """
    spark = archives.sparkSession
    schema = READ if with_payload else READ.replace("payload binary, ", "")
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def row(path: str, record: Record) -> dict:
        digest = record.headers.get("warc-payload-digest", "").removeprefix("sha1:")
        revisit, url = record.type == "revisit", record.headers.get("warc-target-uri")
        return {
            "path": path,
            "page_id": _page_of(record.headers.get("warc-record-id")),
            "url": None if url is None else unquote(url),
            "record_type": record.type,
            "refers_to": _page_of(record.headers.get("warc-refers-to")),
            "payload": None if revisit else record.payload,
            "payload_bytes": int(record.http.get("content-length", 0)) if revisit else len(record.payload),
            "payload_digest": base64.b32decode(digest).hex() if revisit else hashlib.sha1(record.payload).hexdigest(),
            "digest_ok": verified(record),
        }

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, place = fs.FileSystem.from_uri(path)
                with filesystem.open_input_stream(place, compression=None) as stream:
                    rows, size = [], 0
                    for record in read_records(stream):
                        rows.append(row(path, record))
                        size += len(record.payload) if with_payload else 100
                        if size >= READ_BYTES * 16:
                            yield _batch(rows, fields)
                            rows, size = [], 0
                    yield _batch(rows, fields)

    # As many tasks as there may be, so that each has few archives.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(parts, "path").mapInArrow(run, schema)


def _batch(rows: list[dict], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], type=f.type) for f in fields], schema=fields)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes the archives into a staged folder and reads them back: one row for each row of ``pages``.

    A null html is an empty payload, a null url is left out. An empty table makes no record.
    """
    staging = Staging(pages.sparkSession, "warc")
    archives = staging.write(write_archives(pages, f"{staging.path}/archives"), "list")
    return read_archives(archives, with_payload=False)
