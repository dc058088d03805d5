"""Legacy archives converted to WARC, with payloads that repeat written as revisits (8).

An ARC file is a run of records, each a header line and as many bytes as it declares. The
file's first record tells its version: version 1 header lines carry five fields, version 2
ten. `convert_arc` reads such files and synthesises WARC records: the identifier is a UUID
made from the record's own bytes, so a retried task writes the same file; the timestamp
comes from the fourteen-digit archive date; the type and the digests from the content.

`write_legacy`, `convert` and `read_archives` go from a frame to folders of archives and
back. The files are gzipped as wholes, which readers of both formats accept.
Which record holds a payload is decided by a partial aggregate on its digest, whatever the
number of copies.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import as_bytes, map_batches
from saleslake.plans.staging import new_folder, stored

# The fields of an ARC header line by version, and the WARC version line.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename",
        "length"),
}
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, as archives state it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass(frozen=True)
class ArcRecord:
    """One record of a legacy archive: the fields of its header line, and its bytes."""

    version: int
    fields: dict[str, str]
    body: bytes


@dataclass(frozen=True)
class WarcRecord:
    """A record's named headers, and its block."""

    headers: dict[str, str]
    block: bytes = field(repr=False)
    payload_bytes: int = 0


def arc_line(version: int, values: dict[str, str]) -> bytes:
    """A header line; a field that is missing is a dash."""
    words = [values.get(name) or "-" for name in ARC_FIELDS[version]]
    return (" ".join(words) + "\n").encode()


def read_arc(stream) -> Iterator[ArcRecord]:
    """Records of an ARC file.

    The first record names the version in its body. A later header line is split from the
    right, so blanks in a url stay in it. A record whose declared length runs past the end
    of the file is an error, as is a line with too few fields.
    """
    version = 1
    first = True
    while line := stream.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if first and not text.startswith("filedesc:"):
            raise ValueError("not an ARC file: the first record is no file description")
        names = ARC_FIELDS[1 if first else version]
        words = text.rsplit(" ", len(names) - 1)
        if len(words) != len(names):
            names = ARC_FIELDS[2] if len(names) == 5 else ARC_FIELDS[1]
            words = text.rsplit(" ", len(names) - 1)
        if len(words) != len(names) or not words[-1].isdigit():
            raise ValueError(f"bad ARC header line: {text[:200]!r}")
        values = dict(zip(names, words, strict=True))
        size = int(values["length"])
        body = stream.read(size)
        if len(body) != size:
            raise ValueError("an ARC record is shorter than it declares")
        if first:
            version = int(body.split(None, 1)[0]) if body.split() else 1
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            first = False
            continue
        yield ArcRecord(version, values, body)


def arc_description(version: int, name: str, date: str) -> bytes:
    """The record an ARC file begins with."""
    names = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "type": "Content-type",
             "length": "Archive-length", "status": "Result-code", "checksum": "Checksum",
             "location": "Location", "offset": "Offset", "filename": "Filename"}
    body = (
        f"{version} 0 converter\n" + " ".join(names[x] for x in ARC_FIELDS[version]) + "\n"
    ).encode()
    line = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n".encode()
    return line + body + b"\n"


def arc_record(version: int, values: dict[str, str], body: bytes) -> bytes:
    return arc_line(version, values | {"length": str(len(body))}) + body + b"\n"


def _timestamp(date: str) -> str:
    """An archive date of four to fourteen digits as WARC-Date; unusable ones are the epoch."""
    digits = date if date.isdigit() else ""
    filled = digits + "00000101000000"[len(digits):] if 4 <= len(digits) <= 14 else ""
    try:
        moment = datetime.strptime(filled, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    except ValueError:
        moment = datetime.fromtimestamp(0, UTC)
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def to_warc(record: ArcRecord, refers_to: str | None = None) -> WarcRecord:
    """The WARC record of a legacy one; a revisit of the record `refers_to` if that is given.

    The content of an `http` record is a whole response, headers first; anything else is a
    resource. A revisit states the payload's digest and has no payload.
    """
    body = record.body
    is_http = record.fields["url"].startswith(("http://", "https://")) and body.startswith(b"HTTP/")
    head, sep, payload = body.partition(b"\r\n\r\n") if is_http else (b"", b"", body)
    if is_http and not sep:
        head, sep, payload = body, b"", b""
    digest = payload_digest(payload)
    identity = uuid.uuid5(
        _NAMESPACE, " ".join([record.fields["url"], record.fields["date"], payload_digest(body)])
    )
    block = head + sep if refers_to else body
    headers = {
        "WARC-Type": "revisit" if refers_to else "response" if is_http else "resource",
        "WARC-Record-ID": f"<urn:uuid:{identity}>",
        "WARC-Date": _timestamp(record.fields["date"]),
        "WARC-Target-URI": record.fields["url"],
        "WARC-IP-Address": record.fields["ip"],
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
        "Content-Type": "application/http; msgtype=response" if is_http else record.fields["type"],
    }
    if refers_to:
        headers |= {"WARC-Refers-To": refers_to, "WARC-Profile": REVISIT_PROFILE}
    return WarcRecord(headers, block, len(payload))


def warc_bytes(record: WarcRecord) -> bytes:
    lines = [f"{name}: {' '.join(value.split())}" for name, value in record.headers.items()
             if value and value != "-"]
    lines.append(f"Content-Length: {len(record.block)}")
    head = WARC_VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"
    return head + record.block + b"\r\n\r\n"


def read_warc(stream) -> Iterator[WarcRecord]:
    """Records of a WARC file, plain or gzipped by record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is shorter than it declares")
        yield WarcRecord(headers, block)


def convert_arc(content: bytes) -> bytes:
    """A legacy archive as WARC, every record whole: one pass over the file."""
    return b"".join(warc_bytes(to_warc(record)) for record in read_arc(_opened(content)))


def _opened(content: bytes) -> io.BytesIO:
    return io.BytesIO(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)


# A page's own number travels in its response headers, and from there in WARC extension
# headers. `X-` names are extensions; readers pass over those they do not know.
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PAGE = re.compile(rb"\r\nX-Page-Id: (-?\d+)\r\n")
_ARCHIVE_BYTES = 8 << 20


def _packed_archives(
    records: Iterator[bytes], prologue: bytes = b""
) -> Iterator[pa.RecordBatch]:
    """Records put together into archives of about 8 MB, one to a row."""

    def row(parts: list[bytes]) -> pa.RecordBatch:
        # Spark's text writer ends the row with a line feed
        return pa.RecordBatch.from_arrays(
            [pa.array([b"".join(parts).removesuffix(b"\n")], pa.binary())], ["value"]
        )

    parts, size = [prologue], 0
    for record in records:
        parts.append(record)
        size += len(record)
        if size >= _ARCHIVE_BYTES:
            yield row(parts)
            parts, size = [prologue], 0
    if size:
        yield row(parts)


def _write_files(archives: DataFrame, path: str) -> None:
    """One gzipped file for each row, its bytes as they are."""
    (
        archives.select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", "\n").option("maxRecordsPerFile", 1)
        .option("compression", "gzip").text(path)
    )


def _legacy_batch(batch: pa.RecordBatch, version: int) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[bytes]:
        pages, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for page, url, payload in zip(pages, urls, as_bytes(batch.column(2)), strict=True):
            safe = "".join((url or "").split()) or "-"
            if not safe.startswith(("http://", "https://")):
                safe = f"http://unknown.invalid/{safe}"
            head = _HTTP if page is None else f"{_HTTP}X-Page-Id: {page}\r\n"
            values = {"url": safe, "ip": "0.0.0.0", "date": "19960101000000", "type": "text/html"}
            yield arc_record(version, values, f"{head}\r\n".encode() + (payload or b""))

    yield from _packed_archives(records(), arc_description(version, "pages.arc", "19960101000000"))


def write_legacy(
    pages: DataFrame, path: str, *, version: int = 1, id_column: str = "page_id",
    url_column: str = "url", html_column: str = "html",
) -> None:
    """ARC files of a frame of pages below `path`; a null html is an empty payload."""
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").alias("url"), F.col(f"`{html_column}`").alias("html"),
    )
    _write_files(map_batches(rows, partial(_legacy_batch, version=version), "value binary"), path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


_RECORD = (
    "page_id long, record_id string, digest binary, size long, url string, date string,"
    " ip string, type string, body binary"
)


def _record_batch(batch: pa.RecordBatch, bodies: bool) -> Iterator[pa.RecordBatch]:
    for content in batch.column(0):
        rows: list[tuple] = []
        size = 0
        for record in read_arc(_opened(content.as_py())):
            found = to_warc(record)
            # in the response's head only: a payload may hold such a line, too
            page = _PAGE.search(record.body, 0, record.body.find(b"\r\n\r\n") + 2)
            digest = found.headers["WARC-Payload-Digest"].removeprefix("sha1:")
            rows.append((
                int(page[1]) if page else None, found.headers["WARC-Record-ID"],
                digest.encode(), found.payload_bytes, record.fields["url"], record.fields["date"],
                record.fields["ip"], record.fields["type"], record.body if bodies else None,
            ))
            size += len(record.body)
            if size > _ARCHIVE_BYTES:
                yield _record_rows(rows)
                rows, size = [], 0
        if rows:
            yield _record_rows(rows)


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(),
             pa.string(), pa.string(), pa.binary())
    names = [word.split()[0] for word in _RECORD.split(",")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
    )


def read_legacy(spark: SparkSession, path: str, *, bodies: bool = True) -> DataFrame:
    """The records of all ARC files below `path`, with the identity they get as WARC."""
    return map_batches(_files(spark, path), partial(_record_batch, bodies=bodies), _RECORD)


def _convert_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[bytes]:
        for row in batch.to_pylist():
            legacy = ArcRecord(1, {k: row[k] for k in ("url", "date", "ip", "type")}, row["body"])
            found = to_warc(legacy, row["first_record"])
            extra = {"X-Payload-Length": str(found.payload_bytes)}
            if row["page_id"] is not None:
                extra["X-Page-Id"] = str(row["page_id"])
            if row["first_page"] is not None:
                extra["X-Refers-To-Page"] = str(row["first_page"])
            found.headers.update(extra)
            yield warc_bytes(found)

    yield from _packed_archives(records())


def convert(spark: SparkSession, legacy: str, path: str, *, least_bytes: int = 0) -> None:
    """Convert all ARC files below `legacy` to WARC files below `path`.

    Of records with equal payloads of at least `least_bytes`, that with the smallest page
    number is written whole and the others as revisits of it; records that share that number
    are all whole, and so are records without a number if none of the equal ones has one.
    Copies are counted by a partial aggregate, and only payloads with copies are looked up.
    """
    firsts = stored(
        read_legacy(spark, legacy, bodies=False)
        .filter(F.col("size") >= least_bytes).groupBy("digest")
        .agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id")))
            .alias("first"),
            F.count(F.lit(1)).alias("copies"),
        )
        .filter("copies > 1 AND first IS NOT NULL")
        .select("digest", "first"),
        "warc-firsts",
    )
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    joined = read_legacy(spark, legacy).join(firsts, "digest", "left").select(
        "page_id", "url", "date", "ip", "type", "body",
        F.when(other & (F.col("size") >= least_bytes), F.col("first.page_id")).alias("first_page"),
        F.when(other & (F.col("size") >= least_bytes), F.col("first.record_id"))
        .alias("first_record"),
    )
    _write_files(map_batches(joined, _convert_batch, "value binary"), path)


_WARC = (
    "page_id long, record_id string, record_type string, url string, payload_bytes long,"
    " payload_digest string, refers_to long, payload binary"
)


def _warc_batch(batch: pa.RecordBatch, payloads: bool) -> Iterator[pa.RecordBatch]:
    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    names = [word.split()[0] for word in _WARC.split(",")]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(),
             pa.int64(), pa.binary())
    for content in batch.column(0):
        rows = []
        for record in read_warc(_opened(content.as_py())):
            headers = record.headers
            payload = record.block
            if headers.get("Content-Type", "").startswith("application/http"):
                payload = payload.partition(b"\r\n\r\n")[2]
            revisit = headers["WARC-Type"] == "revisit"
            stated = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
            size = number(headers.get("X-Payload-Length"))
            if not revisit:
                size = len(payload)
                if stated and payload_digest(payload) != stated:
                    raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
            rows.append((
                number(headers.get("X-Page-Id")), headers["WARC-Record-ID"], headers["WARC-Type"],
                headers.get("WARC-Target-URI"), size, stated,
                number(headers.get("X-Refers-To-Page")),
                payload if payloads and not revisit else None,
            ))
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
            )


def read_archives(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """The records of all WARC files below `path`; whole payloads are checked by their digest.

    A folder without records gives an empty frame.
    """
    return map_batches(_files(spark, path), partial(_warc_batch, payloads=payloads), _WARC)


def archive_pages(pages: DataFrame, *, version: int = 1, least_bytes: int = 0, **columns: str):
    """Write pages as legacy archives, convert them, and read the WARC files back."""
    spark = pages.sparkSession
    legacy, archives = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_legacy(pages, legacy, version=version, **columns)
    convert(spark, legacy, archives, least_bytes=least_bytes)
    return read_archives(spark, archives)
