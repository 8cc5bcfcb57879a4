"""WARC archives: written a gzip member per record, read back sequentially.

A reader goes through a file once, in chunks: it inflates one gzip member after the
other, takes the record header up to the blank line, then as many bytes as the header's
Content-Length says, and checks the block's and the payload's SHA-1. No more than one
record and one chunk are held at a time. Tasks work on files, so archives are
rolled over at a size that one task reads easily.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cornerstore.llm.frames import ship
from cornerstore.session import shared_folder, write_and_reread

CHUNK = 1 << 16
FILE_BYTES = 1 << 30
MIN_REVISIT_BYTES = 1000
MAX_HEADER_BYTES = 1 << 20
DATE = "2000-01-01T00:00:00Z"  # of every record, unless another is given
# Fixed values of the format.
VERSION = "WARC/1.1"
END_OF_RECORD = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_BLOCK = "application/http; msgtype=response"

_DEALS = 16
_MOST_TASKS = 100_000
_ROWS_BYTES = 8 << 20  # an Arrow batch of records is passed on beyond this size


class BrokenArchive(ValueError):
    """A file that is not what its headers say."""


@dataclass(frozen=True)
class Record:
    """Header fields by lower-cased name, the block's HTTP header (if it has one) and the payload after it."""

    offset: int
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def digest_text(data: bytes) -> str:
    """SHA-1 as WARC headers have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_hex(text: str) -> str:
    """Lower-case hex of a header's SHA-1, which may be base 32 or hex."""
    name, _, value = text.partition(":")
    if name.lower() != "sha1" or len(value) not in (32, 40):
        raise BrokenArchive(f"not a SHA-1: {text}")
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def _lines(fields: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None).encode() + b"\r\n"


def pack(kind: str, record_id: str, url: str | None, payload: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """One record as one gzip member. A revisit has the HTTP header, with the payload's length, and no payload.

    Characters that a header line cannot hold are percent-encoded in the URL.
    """
    digest = digest_text(payload)
    http = b"HTTP/1.1 200 OK\r\n" + _lines([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http if kind == "revisit" else http + payload
    safe = None if url is None else quote(url, safe="".join(map(chr, range(0x21, 0x7F))))
    head = f"{VERSION}\r\n".encode() + _lines([
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", safe),
        ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", digest_text(block)),
        ("WARC-Profile", SAME_PAYLOAD if kind == "revisit" else None),
        ("WARC-Refers-To", f"<{refers_to}>" if kind == "revisit" else None),
        ("Content-Type", HTTP_BLOCK), ("Content-Length", str(len(block))),
    ])
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(head) + member.compress(block) + member.compress(END_OF_RECORD) + member.flush()


class _Member:
    """The inflated bytes of one gzip member, asked for piece by piece."""

    def __init__(self, raw: BinaryIO, held: bytes):
        self.raw, self.held, self.out = raw, held, bytearray()
        self.inflate, self.taken = zlib.decompressobj(31), 0

    def _more(self) -> bool:
        """Inflate up to another chunk; False at the member's end."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.held or self.raw.read(CHUNK)
        if data is self.held:
            self.held = b""
        if not data:
            raise BrokenArchive("the file ends inside a record")
        try:
            self.out += self.inflate.decompress(data, CHUNK)
        except zlib.error as error:
            raise BrokenArchive(f"not a gzip member: {error}") from error
        left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.taken += len(data) - len(left)
        if self.inflate.eof:
            self.held = left + self.held
        return True

    def until(self, mark: bytes, limit: int) -> bytes:
        """Bytes up to and with ``mark``."""
        start = 0
        while (at := self.out.find(mark, start)) < 0:
            start = max(0, len(self.out) - len(mark) + 1)
            if len(self.out) > limit:
                raise BrokenArchive(f"no end of the header within {limit} bytes")
            if not self._more():
                raise BrokenArchive("a record without an end of its header")
        return self.take(at + len(mark))

    def take(self, size: int) -> bytes:
        while len(self.out) < size:
            if not self._more():
                raise BrokenArchive(f"a block has {len(self.out)} bytes, its Content-Length says {size}")
        data = bytes(self.out[:size])
        del self.out[:size]
        return data

    def end(self) -> bytes:
        """What follows the member in the file, as far as it was read; the member must be at its end."""
        while self._more():
            if self.out:
                break
        if self.out or not self.inflate.eof:
            raise BrokenArchive("a gzip member has more than one record")
        return self.held


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-cased name; a line that begins with white space goes on with the one before it."""
    found: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not value.isdecimal():
        raise BrokenArchive(f"Content-Length is {value!r}")
    return int(value)


def _record(member: _Member, offset: int) -> Record:
    head = member.until(b"\r\n\r\n", MAX_HEADER_BYTES).decode("utf-8", "replace").split("\r\n")
    if not head[0].startswith("WARC/"):
        raise BrokenArchive(f"a record begins with {head[0][:40]!r}")
    fields = _fields(head[1:])
    block = member.take(_length(fields))
    if member.take(len(END_OF_RECORD)) != END_OF_RECORD:
        raise BrokenArchive("a record does not end with two blank lines")
    http, payload = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        lines, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise BrokenArchive("an HTTP block without an end of its header")
        http = _fields(lines.decode("utf-8", "replace").split("\r\n")[1:])
    stated = fields.get("warc-block-digest")
    if stated and digest_hex(stated) != hashlib.sha1(block).hexdigest():
        raise BrokenArchive("a block does not have its digest")
    stated = fields.get("warc-payload-digest")
    if stated and fields.get("warc-type") != "revisit" and digest_hex(stated) != hashlib.sha1(payload).hexdigest():
        raise BrokenArchive("a payload does not have its digest")
    return Record(offset, fields, http, payload)


def records(raw: BinaryIO, name: str = "archive") -> Iterator[Record]:
    """The records of one file from its first to its last byte; ``BrokenArchive`` names the place of a fault."""
    held, offset = b"", 0
    while held or (held := raw.read(CHUNK)):
        member = _Member(raw, held)
        try:
            yield _record(member, offset)
            held = member.end()
        except BrokenArchive as fault:
            raise BrokenArchive(f"{name}, record at byte {offset}: {fault}") from fault
        offset += member.taken


def with_first_copy(rows: DataFrame, min_bytes: int) -> DataFrame:
    """``rows`` (page_id, url, payload) with first: the largest page_id among the rows of the same payload, where it is larger than the row's own.

    Payloads under ``min_bytes`` have none. Copies are reduced to one row per payload
    and task before the shuffle, and the join on the payload's digest deals the
    copies of each over ``_DEALS`` tasks. Payloads without a copy to look for are dealt by page_id.
    """
    same = F.when(F.length("payload") >= min_bytes, F.sha2("payload", 256))
    rows = rows.withColumn("_same", same)
    firsts = rows.filter("_same is not null").groupBy("_same").agg(F.max("page_id").alias("first"), F.count("*").alias("_copies"))
    firsts = firsts.filter("_copies > 1 and first is not null").select(
        F.col("_same").alias("_digest"), "first", F.explode(F.sequence(F.lit(0), F.lit(_DEALS - 1))).alias("_deal")
    )
    dealt = rows.withColumn("_to", F.pmod(F.xxhash64("page_id", "url"), F.lit(_DEALS)).cast("int"))
    dealt = dealt.withColumn("_same", F.coalesce("_same", F.concat(F.lit("-"), F.xxhash64("page_id").cast("string"))))
    joined = dealt.join(firsts, (F.col("_same") == F.col("_digest")) & (F.col("_to") == F.col("_deal")), "left")
    later = F.col("page_id").isNull() | (F.col("page_id") < F.col("first"))
    return joined.select("page_id", "url", "payload", F.when(later, F.col("first")).alias("first"))


def write_archives(
    pages: DataFrame,
    folder: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """path, n_records, n_bytes of the archives written under ``folder``, a record per row of (page_id, url, html).

    NULL html is an empty payload; a NULL url leaves the record without a target. Of
    rows with equal payloads of ``min_revisit_bytes`` or more the one with the largest
    page_id is a response and the others revisit it. Rows that repeat that page_id are
    responses too, and rows without page_id are responses where no copy has one.
    An empty table writes no file. Other columns are ignored.

    A task that runs again writes files under new names; only those in the result count.
    """
    spark = pages.sparkSession
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(bytearray())).alias("payload"),
    )
    judged = with_first_copy(given, min_revisit_bytes)
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, path, count, size = TaskContext.get().partitionId(), None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "n_records": count, "n_bytes": size}], schema)

        for batch in batches:
            for page_id, url, payload, first in zip(*batch.columns):
                if out is None:
                    path, count, size = f"{folder}/part-{part:06d}-{uuid4().hex}.warc.gz", 0, 0
                    system, name = _open(path)
                    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(name, compression=None)
                first = first.as_py()
                data = pack(
                    "response" if first is None else "revisit", page_uri(page_id.as_py()), url.as_py(), payload.as_py(),
                    None if first is None else page_uri(first), date,
                )
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    ship(spark)
    # Written down at once: the archives must not be made again when the list is read twice.
    return write_and_reread(judged.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-list")


def page_uri(page_id: int | None) -> str:
    return f"urn:uuid:{uuid4()}" if page_id is None else f"urn:page:{page_id}"


def read_archives(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """A row per record of the archives in ``paths`` (path): where it lies, its type, ids and target, its payload.

    payload_digest is lower-case hex. Bytes and digest of a revisit are those of the
    full payload, from its headers; its payload is NULL. A record whose framing or
    digest is wrong ends the job with ``BrokenArchive``. One task reads one file at a time.
    """
    arrow = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
        ("refers_to", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ])

    def row(path: str, record: Record) -> tuple:
        fields, revisit = record.fields, record.fields.get("warc-type") == "revisit"
        digest = fields.get("warc-payload-digest")
        bare = lambda name: fields[name].strip("<>") if name in fields else None
        return (
            path, record.offset, fields.get("warc-type"), bare("warc-record-id"), bare("warc-refers-to"),
            fields.get("warc-target-uri"), _length(record.http) if revisit and record.http else len(record.payload),
            digest_hex(digest) if digest else hashlib.sha1(record.payload).hexdigest(), None if revisit else record.payload,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        held = 0

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), arrow.types)], schema=arrow)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = _open(path)
                with system.open_input_stream(name, compression=None) as raw:
                    for record in records(raw, path):
                        made.append(row(path, record))
                        held += len(record.payload) + 500
                        if held > _ROWS_BYTES:
                            yield passed_on()
                            made, held = [], 0
        if made:
            yield passed_on()

    ship(spark)
    schema = (
        "path string, offset long, record_type string, record_id string, refers_to string, url string, "
        "payload_bytes long, payload_digest string, payload binary"
    )
    listed = paths.select("path")
    # Files are large and few: about one to a task.
    return listed.repartition(min(max(1, listed.count()), _MOST_TASKS)).mapInArrow(run, schema)


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    written = write_archives(pages, folder or shared_folder(spark, "warc"))
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return read_archives(spark, written).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


#: The same rows in SQL.
ARCHIVED_PAGES_SQL = f"""
WITH given AS (SELECT page_id, COALESCE(html, '') AS payload FROM pages),
sized AS (SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes FROM given),
judged AS (
  SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} THEN MAX(page_id) OVER (PARTITION BY payload) END AS newest
  FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN newest IS NOT NULL AND (page_id IS NULL OR page_id < newest) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS NULL OR page_id < newest THEN newest END AS refers_to
FROM judged
"""
