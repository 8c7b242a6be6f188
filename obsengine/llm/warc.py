"""Web archives with a salvaging reader (operator 12).

Writing: every page is one WARC record in a gzip member of its own.  Tasks
gather members to archives of a bounded size, and Spark's file writer commits
each archive as one file.  Of equal payloads only the first is stored; the
others are revisit records that refer to it.

Reading: a member is taken if it inflates and its checksum holds, its record's
header is whole, the block has the stated length and ends in two line breaks,
and the stated digests fit.  Where one of these checks fails, the reader
searches for the next place at which a member or a version line begins and all
checks hold, goes on there, and reports the bytes between as a gap with the
reason.  Archives without compression are read by the same rule.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.session import checkpoint_dir

from .common import staged

#: An archive is closed when it has reached so many bytes.
ARCHIVE_BYTES = 16 << 20
#: Payloads below are always stored.
SMALLEST_REVISIT = 100
#: Read records are handed on in batches of about so many bytes.
BATCH_BYTES = 8 << 20
#: A record's header is at most so long.
LONGEST_HEADER = 1 << 20
#: Pages are written a few at a time, so that no task holds a batch twice.
PAGES_AT_ONCE = 256

# Fixed values of the WARC 1.1 and gzip formats.
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A member without content; it closes every archive.
EMPTY_MEMBER = MEMBER + bytes(6) + b"\xff\x03\x00" + bytes(8)
#: Capture date of records whose pages state none.
DATE = "1970-01-01T00:00:00Z"

RECORDS = (
    "archive string, offset long, length long, gap string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)
#: ``gap`` is NULL in a record; else the row is a quarantined byte range of the
#: archive, ``gap`` says which check failed at its start, and the rest is NULL.

_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_ID = re.compile(r"<urn:page:(-?\d+)>")


class Record(NamedTuple):
    """A whole record: its header fields by lower-case name, its payload (None
    in a revisit), and the payload's bytes and digest."""

    fields: dict[str, str]
    payload: bytes | None
    size: int
    digest: str


class Damaged(Exception):
    """A check that failed; its text is the gap's reason."""


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    """The page's id in a record's id; None where there is none."""
    found = _ID.fullmatch(record or "")
    return int(found[1]) if found else None


def _clean(uri: str) -> str:
    """A URI that fits in a header line: blanks and controls are escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def make_record(
    page_id: int | None, uri: str | None, payload: bytes, first: int | None, digest: str, date: str = DATE
) -> bytes:
    """The bytes of a response record, or of a revisit of ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        *([] if uri is None else [f"WARC-Target-URI: {_clean(uri)}"]),
        *([] if first is None else [f"WARC-Refers-To: {record_id(first)}", f"WARC-Profile: {REVISIT_PROFILE}"]),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + block + END


def _parse(data: bytes, at: int) -> tuple[Record, int]:
    """The record that begins at ``at``, and where it ends."""
    if not (data.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n"), at)):
        raise Damaged("no version line")
    head = data.find(END, at, at + LONGEST_HEADER)
    if head < 0:
        raise Damaged("header not ended")
    fields: dict[str, str] = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        fields.setdefault(name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip())
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Damaged("no length")
    begin = head + len(END)
    end = begin + int(size)
    if data[end : end + len(END)] != END:
        raise Damaged("block does not end where stated")
    block = data[begin:end]
    stated = fields.get("warc-block-digest", "").lower()
    if stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise Damaged("block digest differs")
    return Record(fields, *_payload(fields, block)), end + len(END)


def _take(data: bytes, at: int) -> tuple[list[Record], int]:
    """The records of the member or of the plain record that begins at ``at``,
    and where it ends."""
    if not data.startswith(MEMBER, at):
        record, end = _parse(data, at)
        return [record], end
    inflate = zlib.decompressobj(31)
    parts = []
    try:
        # in steps: a member's input ends long before the archive does
        step, end = 1 << 14, at
        while not inflate.eof and end < len(data):
            parts.append(inflate.decompress(data[end : end + step]))
            end += step
    except zlib.error:
        raise Damaged("member does not inflate") from None
    if not inflate.eof:
        raise Damaged("member not ended")
    end = min(end, len(data)) - len(inflate.unused_data)
    plain = b"".join(parts)
    records, inner = [], 0
    while inner < len(plain):
        record, inner = _parse(plain, inner)
        records.append(record)
    return records, end


def _payload(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int, str]:
    """(payload or None for a revisit, its bytes, its digest), checked."""
    http = "application/http" in fields.get("content-type", "")
    head, found, body = block.partition(END) if http else (b"", True, block)
    if http and not found:
        raise Damaged("HTTP header not ended")
    stated = fields.get("warc-payload-digest", "").lower().removeprefix("sha256:")
    if fields.get("warc-type") == "revisit":
        size = re.search(rb"\r\ncontent-length:\s*(\d+)\s*(?:\r\n|\Z)", head, re.I)
        return None, int(size[1]) if size else 0, stated
    own = hashlib.sha256(body).hexdigest()
    if re.fullmatch("[0-9a-f]{64}", stated) and stated != own:
        raise Damaged("payload digest differs")
    return body, len(body), own


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | str]]:
    """(offset, length, record) of all whole records in an archive, and
    (offset, length, reason) of the byte ranges that hold none, in order.

    Every byte belongs to one range or to a member without records.
    """
    at, bad, why = 0, None, ""
    while at < len(data):
        try:
            records, end = _take(data, at)
        except Damaged as found:
            if bad is None:
                bad, why = at, str(found)
            after = _START.search(data, at + 1)
            at = after.start() if after else len(data)
            continue
        if bad is not None:
            yield bad, at - bad, why
            bad = None
        for record in records:
            yield at, end - at, record
        at = end
    if bad is not None:
        yield bad, len(data) - bad, why


def write_archives(
    pages: DataFrame,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    path: str | None = None,
    level: int = 6,
) -> str:
    """Write one record a row of ``pages`` to archives in a new folder (in the
    shared checkpoint folder unless ``path`` is given) and return it.

    NULL payloads are empty; a NULL URI is left out; a NULL key gives a record
    without a page id.  Of rows with equal payloads of at least
    ``SMALLEST_REVISIT`` bytes, those with the smallest key are responses (all
    of them if such a row is repeated, or if no row has a key) and the others
    refer to it.  An empty table gives an empty folder.  Other columns are not
    read, so their names can't clash.
    """
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    src = pages.select(
        F.col(key).cast("long").alias("k"),
        F.col(uri).cast("string").alias("u"),
        F.encode(F.coalesce(F.col(payload), F.lit("")), "utf-8").alias("b"),
    ).withColumn("d", F.sha2("b", 256))
    large = F.octet_length("b") >= SMALLEST_REVISIT
    # only payloads that occur twice matter; the table of firsts is written, so
    # that the join knows its size and pages move only where it is large
    firsts = src.where(large).groupBy("d").agg(F.min("k").alias("first"), F.count("*").alias("n"))
    firsts = staged(firsts.where("n > 1 AND first IS NOT NULL").select("d", "first"), "firsts")
    rows = src.join(firsts, "d", "left").select(
        "k", "u", "b", "d", F.when(large & (F.col("k").isNull() | (F.col("k") > F.col("first"))), F.col("first")).alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]):
        members: list[bytes] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                for k, u, b, d, first in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = squeeze.compress(make_record(k, u, b, first, d)) + squeeze.flush()
                    members.append(member)
                    size += len(member)
                    if size >= archive_bytes:
                        yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(members)], pa.binary())})
                        members, size = [], 0
        if members:
            yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(members)], pa.binary())})

    # one row is one file; the writer's line end is an empty member
    archives = rows.mapInArrow(run, "archive binary")
    archives.select(F.col("archive").cast("string").alias("value")).write.option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")
    ).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)
    return path


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records and all quarantined gaps of the archives in a folder, with
    the columns of ``RECORDS`` (``payload`` only with ``with_payload``).

    ``archive`` is the file's name, ``offset`` and ``length`` the record's
    member in it.  A revisit has no payload; its digest and bytes are those of
    the payload it refers to.  An archive is one row of Spark's binary reader,
    so a single one may have up to 2 GB.
    """
    files = spark.read.format("binaryFile").load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = RECORDS
    if not with_payload:
        names, schema = names[:-1], RECORDS.rpartition(", ")[0]
    types = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows: list[tuple] = []
                size = 0
                for offset, length, found in salvage(data):
                    if isinstance(found, str):
                        rows.append((name, offset, length, found, *[None] * 7))
                    else:
                        f = found.fields
                        rows.append(
                            (name, offset, length, None, f.get("warc-type"), f.get("warc-record-id"),
                             f.get("warc-target-uri"), f.get("warc-refers-to"), found.digest, found.size, found.payload)
                        )
                        size += len(found.payload or b"") + 500
                    if size > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(c, types.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=False)]
        return pa.RecordBatch.from_arrays(cols, names)

    return files.mapInArrow(run, schema)


def pages_of(records: DataFrame) -> DataFrame:
    """One row a response or revisit among read records: page_id,
    payload_bytes, payload_digest, record_type, refers_to (a page id)."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return records.where("gap IS NULL AND record_type IN ('response', 'revisit')").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write the pages' archives, read them back, and tell each page's record."""
    return pages_of(read_archives(pages.sparkSession, write_archives(pages), with_payload=False))


# DuckDB SQL for ``archive_digest``.
ORACLE = f"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= {SMALLEST_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM f
"""
