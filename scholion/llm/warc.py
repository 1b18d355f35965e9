"""From legacy ARC archives to WARC archives and back to rows.

An ARC file is a version block (``filedesc://``) and one record after the other: a header line
whose fields depend on the version, the declared number of bytes, a line end. The converter reads
by those lines and lengths alone, never by what the bytes look like, and synthesises what WARC
asks for: record ids, ISO times, record types, digests. Of records with equal payloads the first
is a response, the others revisit it.

Files are written and read by Spark's own readers and writers, so any file system it knows will
do. A task makes one archive as one row, and the writer one file of each row; gzip packs a file
as one member.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, byte_bounded, shared_folder, slices, written

# Header fields of the two versions, and the WARC profile of a revisit.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RESPONSE, REVISIT = "response", "revisit"
PAGE_HEADER = b"X-Page-Id"

#: An archive ends with the record that reaches this size.
ARCHIVE_BYTES = 16 << 20
#: Smaller payloads are stored each time.
REVISIT_BYTES = 100
#: Time and address of pages that come without them.
FETCHED, ADDRESS = "20240101000000", "0.0.0.0"

GZIP = b"\x1f\x8b"
#: Above all characters of a URL, what ``quote`` is to leave alone.
URL_SAFE = "!#$%&'()*+,/:;=?@[]~\"<>\\^`{|}"


# --- files -------------------------------------------------------------------------


def write_archives(archives: DataFrame, path: str, record_end: str) -> None:
    """One file for each row of ``archive``; the writer adds the end of the last record."""
    (
        archives.write.option("maxRecordsPerFile", 1)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("lineSep", record_end)
        .text(path)
    )


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of the archives below a folder."""
    byte_bounded(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), "content")


def opened(content: bytes) -> BinaryIO:
    """Bytes of an archive, read as a stream; gzip files may have many members."""
    stream = io.BytesIO(content)
    return gzip.GzipFile(fileobj=stream) if content.startswith(GZIP) else stream


def raw_strings(values: list[bytes]) -> pa.Array:
    """Bytes as they are, in the type that Spark's text writer takes."""
    return pa.array(values, pa.binary()).view(pa.string())


def archived(rows: Iterator[tuple], begin, record, between: bytes, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows as archives of some ``limit`` bytes: ``begin(number)`` is the head of the archive of that
    number, ``record(number, *row)`` one of its records."""
    parts: list[bytes] = []
    size = number = 0

    def whole() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([raw_strings([between.join(parts)])], names=["value"])

    for row in rows:
        if not parts:
            parts, size = [begin(number)], 0
        parts.append(record(number, *row))
        size += len(parts[-1])
        if size >= limit:
            yield whole()
            parts, number = [], number + 1
    if parts:
        yield whole()


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = 100) -> Iterator[tuple]:
    """Rows as tuples, a slice of a batch at a time."""
    for part in slices(batches, rows):
        yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def in_slices(rows: Iterator[tuple], types: pa.Schema, most: int = 500, limit: int = ARCHIVE_BYTES) -> Iterator[pa.RecordBatch]:
    """Tuples as batches of so many rows, or of so many bytes of binary values."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= most or size >= limit:
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, r, strict=True)) for r in held], schema=types)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(types.names, r, strict=True)) for r in held], schema=types)


# --- ARC ---------------------------------------------------------------------------


def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 scholion\n{ARC_FIELDS[version]}\n".encode()
    kind = f"200 - - 0 {name} " if version == 2 else ""
    return f"filedesc://{name} {ADDRESS} {date} text/plain {kind}{len(body)}\n".encode() + body


def arc_line(version: int, url: str, date: str, name: str, message: bytes) -> bytes:
    more = f"200 {hashlib.md5(message).hexdigest()} - 0 {name} " if version == 2 else ""
    return f"{url} {ADDRESS} {date} text/html {more}{len(message)}\n".encode()


def http_message(page_id: int | None, payload: bytes) -> bytes:
    """A page as its server sent it. The page's id travels in a header of its own."""
    own = b"" if page_id is None else b"%s: %d\r\n" % (PAGE_HEADER, page_id)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own
    return head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload


def arc_archives(
    pages: DataFrame, versions: tuple[int, ...] = (1, 2), date: str = FETCHED, limit: int = ARCHIVE_BYTES
) -> DataFrame:
    """(page_id, url, html) as rows of whole ARC files, whose versions take turns. A null html is
    empty; a URL without characters is '-', spaces and what is no ASCII are percent-encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        version = lambda number: versions[(task + number) % len(versions)]

        def begin(number: int) -> bytes:
            return version_block(version(number), f"{task}-{number}.arc", date)

        def record(number: int, page_id: int | None, url: str, html: bytes) -> bytes:
            message = http_message(page_id, html)
            shown = quote(url, safe=URL_SAFE) or "-"
            return arc_line(version(number), shown, date, f"{task}-{number}.arc", message) + message

        yield from archived(rows_of(batches), begin, record, b"\n", limit)

    byte_bounded(pages.sparkSession)
    empty = F.lit("")
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", empty).alias("url"),
        F.coalesce("html", empty).cast("binary").alias("html"),
    )
    return narrow.mapInArrow(run, "value string")


class ArcRecord(NamedTuple):
    offset: int
    version: int
    url: bytes
    address: bytes
    date: bytes
    kind: bytes
    block: bytes
    whole: bool


def arc_records(stream: BinaryIO) -> Iterator[ArcRecord]:
    """Records by header lines and declared lengths. Fields are counted from the right, as a URL
    may hold spaces. Line ends between records are passed over; a record that the file cuts off
    comes with what is left of it; a header that is none of its version ends the file with an error."""
    version = offset = 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        names = ARC_FIELDS.get(version, ARC_FIELDS[1]).split()
        fields = line.rstrip(b"\r\n").rsplit(b" ", len(names) - 1)
        is_block = line.startswith(b"filedesc://")
        if is_block:
            # the version is known only from the block's body; the length is last in both
            fields = line.rstrip(b"\r\n").rsplit(b" ", 1)
        if not fields[-1].isdigit() or not (is_block or len(fields) == len(names)):
            raise ValueError(f"no ARC header at byte {start}: {line[:80]!r}")
        length = int(fields[-1])
        block = stream.read(length)
        offset += len(block)
        if is_block:
            version = int(block.split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            yield ArcRecord(start, version or 1, *fields[:4], block, len(block) == length)


def split_message(block: bytes) -> tuple[bytes, bytes]:
    """Head of an HTTP message, its blank line included, and payload. A block that is no such
    message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, end, payload = block.partition(b"\r\n\r\n")
    return head + end, payload


def header(head: bytes, name: bytes) -> bytes | None:
    """Value of the first header line of that name."""
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower():
            return value.strip()
    return None


def number(value: bytes | None) -> int | None:
    return int(value) if value and value.lstrip(b"-").isdigit() else None


ARC_ROWS = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("version", pa.int32()), ("url", pa.string()), ("address", pa.string())]
    + [("date", pa.string()), ("kind", pa.string()), ("whole", pa.bool_()), ("page_id", pa.int64())]
    + [("payload_bytes", pa.int64()), ("digest", pa.string()), ("block", pa.binary())]
)
ARC_COLUMNS = (
    "file string, offset long, version int, url string, address string, date string, kind string, whole boolean, "
    "page_id long, payload_bytes long, digest string, block binary"
)


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """One row per ARC record below a folder: where it lies, its header fields, payload_bytes and
    digest (SHA-256) of its payload, and the block (HTTP message) unless it is not wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for file, content in rows_of(batches, 1):
                for r in arc_records(opened(content)):
                    head, payload = split_message(r.block)
                    texts = (v.decode("utf-8", "replace") for v in (r.url, r.address, r.date, r.kind))
                    yield (
                        file, r.offset, r.version, *texts, r.whole, number(header(head, PAGE_HEADER)),
                        len(payload), hashlib.sha256(payload).hexdigest(), r.block if with_block else None,
                    )

        yield from in_slices(rows(), ARC_ROWS)

    return archive_files(spark, path).mapInArrow(run, ARC_COLUMNS)


# --- WARC --------------------------------------------------------------------------


def record_id(page_id: int | None, file: str, offset: int) -> str:
    """A UUID of version 8 from the record's place. It holds the page's id, if there is one, so
    that a reference to a record tells the page without a join."""
    name = file.rsplit("/", 1)[-1]
    bits = int.from_bytes(hashlib.sha256(f"{name}:{offset}".encode()).digest()[:16], "big")
    known = page_id is not None
    free = bits & ((1 << 57) - 1)
    # 122 bits are free: the id or bits of the place, whether it is an id, more bits of the place
    upper = page_id & (2**64 - 1) if known else bits >> 64
    value = (upper << 58) | (known << 57) | free
    a, b, c = value >> 74, (value >> 62) & 0xFFF, value & ((1 << 62) - 1)
    return str(uuid.UUID(int=(a << 80) | (8 << 76) | (b << 64) | (2 << 62) | c))


def page_of(name: str | None) -> int | None:
    """The page's id in a record's id, null if it holds none."""
    if not name:
        return None
    i = uuid.UUID(name.removeprefix("<urn:uuid:").removesuffix(">")).int
    value = ((i >> 80) << 74) | (((i >> 64) & 0xFFF) << 62) | (i & ((1 << 62) - 1))
    if not value >> 57 & 1:
        return None
    upper = value >> 58
    return upper - 2**64 if upper >> 63 else upper


def iso_date(arc_date: str) -> str:
    """14 digits, or the first of them, as ISO 8601; what is no time is the start of 1970."""
    d = arc_date if arc_date.isdigit() and len(arc_date) >= 4 else "1970"
    full = d[:14] + "00000101000000"[len(d[:14]) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def warc_info(name: str) -> bytes:
    block = b"software: scholion\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id(None, name, 0)}>"),
        ("WARC-Date", iso_date(FETCHED)),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return warc_record(fields, block)


def converted(r: dict) -> bytes:
    """The WARC record of an ARC record that knows the first record with its payload."""
    first = r["first"]
    is_first = first is None or (first["file"], first["offset"]) == (r["file"], r["offset"])
    head, _ = split_message(r["block"])
    block = r["block"] if is_first else head
    known = lambda v, none: None if v == none else v
    message = bool(head)
    kind = RESPONSE if message else "resource"
    fields = [
        ("WARC-Type", kind if is_first else REVISIT),
        ("WARC-Record-ID", f"<urn:uuid:{record_id(r['page_id'], r['file'], r['offset'])}>"),
        ("WARC-Date", iso_date(r["date"])),
        ("WARC-Target-URI", known(r["url"], "-")),
        ("WARC-IP-Address", known(r["address"], ADDRESS)),
        ("WARC-Payload-Digest", f"sha256:{r['digest']}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Truncated", None if r["whole"] else "unspecified"),
    ]
    if not is_first:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", f"<urn:uuid:{record_id(first['page_id'], first['file'], first['offset'])}>"),
            ("WARC-Refers-To-Target-URI", known(first["url"], "-")),
            ("WARC-Refers-To-Date", iso_date(first["date"])),
        ]
    fields.append(("Content-Type", "application/http;msgtype=response" if message else r["kind"]))
    return warc_record(fields, block)


def first_records(records: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(digest, first) for payloads that occur more than once and are not smaller than that.
    The first has the smallest page id, and null ids come last; equal ids go by place."""
    place = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "file", "offset", "url", "date")
    groups = records.where(F.col("payload_bytes") >= least_bytes).groupBy("digest")
    return groups.agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, limit: int = ARCHIVE_BYTES) -> None:
    """ARC files below one folder -> WARC files in another.

    A first pass reads places and digests and finds the first record of each repeated payload, a
    second one reads the blocks and meets them. The repeated payloads are a written table that
    is broadcast only while it is small; beyond that Spark shuffles, and splits hot payloads.
    """
    firsts = written(first_records(read_arc(spark, arc_path, with_block=False)))
    rows = read_arc(spark, arc_path).join(broadcast_if_small(firsts), "digest", "left")
    columns = ("file", "offset", "url", "address", "date", "kind", "whole", "page_id", "digest", "block", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        yield from archived(
            rows_of(batches),
            lambda at: warc_info(f"{task}-{at}.warc.gz"),
            lambda _, *row: converted(dict(zip(columns, row, strict=True))),
            b"\r\n\r\n",
            limit,
        )

    write_archives(rows.select(*columns).mapInArrow(run, "value string"), warc_path, "\r\n\r\n")


def warc_records(stream: BinaryIO) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields by lower-case name, block) by declared lengths."""
    offset = 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {start}: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            offset += len(line)
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        offset += len(line) + len(block)
        if len(block) < length:
            raise ValueError(f"the record at byte {start} is cut off")
        yield start, fields, block


WARC_ROWS = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string())]
    + [("target_uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_to", pa.string()), ("refers_to_page", pa.int64()), ("payload", pa.binary())]
)
WARC_COLUMNS = (
    "file string, offset long, record_type string, record_id string, target_uri string, date string, page_id long, "
    "payload_bytes long, payload_digest string, refers_to string, refers_to_page long, payload binary"
)


def warc_row(file: str, offset: int, fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A response's size and digest are those of the bytes read, and must be the declared ones; a
    revisit's are those that its headers declare for the payload it stands for."""
    head, payload = split_message(block)
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2]
    size = number(header(head, b"Content-Length")) if head else len(payload)
    if fields["warc-type"] != REVISIT:
        found = hashlib.sha256(payload).hexdigest()
        if digest and digest != found:
            raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
        digest, size = found, len(payload)
    refers_to = fields.get("warc-refers-to")
    return (
        file, offset, fields["warc-type"], fields["warc-record-id"], fields.get("warc-target-uri"), fields["warc-date"],
        page_of(fields["warc-record-id"]), size, digest, refers_to, page_of(refers_to),
        payload if with_payload and fields["warc-type"] != REVISIT else None,
    )


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the WARC files below a folder, but for their warcinfo records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for file, content in rows_of(batches, 1):
                for offset, fields, block in warc_records(opened(content)):
                    if fields["warc-type"] != "warcinfo":
                        yield warc_row(file, offset, fields, block, with_payload)

        yield from in_slices(rows(), WARC_ROWS)

    return archive_files(spark, path).mapInArrow(run, WARC_COLUMNS)


def pages_through_archives(pages: DataFrame, versions: tuple[int, ...] = (1, 2), limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages written to ARC files, converted to WARC files, and read back (see ``read_warc``).

    A null html is an empty payload, a null URL an unknown one; null ids stay null and come last
    among equal payloads. Rows that repeat an id are records of their own. An empty table gives no
    rows, extra columns are ignored. Both kinds of files stay in the shared folder.
    """
    spark, root = pages.sparkSession, shared_folder(pages.sparkSession)
    write_archives(arc_archives(pages, versions, limit=limit), f"{root}/arc", "\n")
    convert_archives(spark, f"{root}/arc", f"{root}/warc", limit)
    return read_warc(spark, f"{root}/warc", with_payload=False)
