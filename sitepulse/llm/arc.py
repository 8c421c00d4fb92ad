"""Legacy web archives (ARC) to WARC, and WARC files written and read with Spark.

An ARC file opens with a version block, whose second line names the version; its URL records have a header line of
fields parted by spaces (five in version 1, ten in version 2), of which the last is the number of bytes that follow.
The converter reads those lines and lengths and makes the equivalent WARC records: identifiers from the content, so that
they are the same on every run, timestamps from the 14-digit dates, types from the scheme, digests over the bytes.

Files are written and read as text whose separator is the end of a WARC record, so any file system that Spark reaches
will do. A record is put together again from what the separator cut, by its declared length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.text import BATCH_BYTES, arrow_schema
from sitepulse.session import scratch_path, stage

# Field names of the ARC header lines and the WARC version line.
ARC_V1 = ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length")
ARC_V2 = (
    "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
    "Archive-length",
)
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

END = b"\r\n\r\n"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:sitepulse:arc")
_DATE = re.compile(rb"\d{4,14}")


class ArcError(ValueError):
    """A header line or a length that does not fit its version."""


@dataclass(frozen=True)
class ArcRecord:
    url: str
    ip: str
    date: str  # 14 digits
    content_type: str
    block: bytes
    status: str | None = None


def arc_header(version: int, name: str, date: str) -> bytes:
    """The version block that opens a file."""
    fields = {1: ARC_V1, 2: ARC_V2}[version]
    body = f"{version} 0 sitepulse\n{' '.join(fields)}\n\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {date} text/plain"
    more = "" if version == 1 else f" 200 - - 0 {name}"
    return f"{line}{more} {len(body)}\n".encode() + body


def arc_record(version: int, record: ArcRecord, name: str = "-", offset: int = 0) -> bytes:
    """One URL record, with the line end that closes it."""
    parts = [_field(record.url), _field(record.ip), record.date, _field(record.content_type)]
    if version == 2:
        parts += [record.status or "-", "-", "-", str(offset), _field(name)]
    return " ".join([*parts, str(len(record.block))]).encode() + b"\n" + record.block + b"\n"


def _field(value: str) -> str:
    """A field as it may stand in a header line: no white space or controls, not empty."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) or "-"


def parse_arc(data: bytes, version: int | None = None) -> Iterator[ArcRecord]:
    """The URL records of a file, or of records cut from one if ``version`` is given."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ArcError(f"header line at byte {at} has no end")
        fields = data[at:end].rstrip(b"\r").split(b" ")
        at = end + 1
        try:
            length = int(fields[-1])
        except ValueError:
            raise ArcError(f"no length in {fields!r}") from None
        if length < 0 or at + length > len(data):
            raise ArcError(f"{length} bytes declared, {len(data) - at} left")
        block, at = data[at : at + length], at + length
        if fields[0].startswith(b"filedesc://") and version is None:
            version = _version(block)
            continue
        names = {1: ARC_V1, 2: ARC_V2}.get(version or 0)
        if names is None or len(fields) < len(names):
            raise ArcError(f"{len(fields)} fields do not fit version {version}")
        # A URL written with spaces makes more fields; the others are taken from the right.
        extra = len(fields) - len(names)
        named = dict(zip(names, [b" ".join(fields[: extra + 1]), *fields[extra + 1 :]]))
        if not _DATE.fullmatch(named["Archive-date"]):
            raise ArcError(f"no date in {fields!r}")
        status = named.get("Result-code", b"-").decode("ascii", "replace")
        yield ArcRecord(
            named["URL"].decode("utf-8", "replace"),
            named["IP-address"].decode("ascii", "replace"),
            named["Archive-date"].decode().ljust(14, "0"),
            named["Content-type"].decode("utf-8", "replace"),
            block,
            None if status == "-" else status,
        )


def _version(block: bytes) -> int:
    first = block.split(b" ", 1)[0].strip()
    if first not in (b"1", b"2"):
        raise ArcError(f"version {first!r}")
    return int(first)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def timestamp(date: str) -> str:
    """A 14-digit date as WARC writes it; months and days of 00 read as 01."""
    y, mo, d, h, mi, s = date[:4], date[4:6], date[6:8], date[8:10], date[10:12], date[12:14]
    return f"{y}-{max(mo, '01')}-{max(d, '01')}T{h}:{mi}:{s}Z"


def head_size(block: bytes) -> int:
    """Bytes up to and with the first empty line, 0 if there is none."""
    ends = [at + len(end) for end in (END, b"\n\n") if (at := block.find(end)) >= 0]
    return min(ends, default=0)


def payload_of(record: ArcRecord) -> tuple[bytes, bytes]:
    """HTTP head (with its empty line) and payload of a block; other blocks are all payload."""
    size = head_size(record.block) if record.block.startswith(b"HTTP/") else 0
    return record.block[:size], record.block[size:]


def is_http(record: ArcRecord) -> bool:
    return record.url.lower().startswith(("http://", "https://"))


def warc_id(kind: str, record: ArcRecord, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ' '.join((kind, record.url, record.date, payload_digest)))}>"


def warc_record(
    record: ArcRecord,
    head: bytes,
    payload: bytes,
    payload_digest: str,
    source_id: int | None = None,
    refers_to: tuple[str, str, int | None] | None = None,
) -> bytes:
    """The WARC record of an ARC record, without the two line ends that close it.

    ``refers_to`` (target, timestamp and source id of the response) makes a revisit, which has the HTTP head only.
    """
    http = bool(head)
    kind = "revisit" if refers_to else "response" if http or is_http(record) else "resource"
    block = head if refers_to else head + payload
    if refers_to or http:
        content_type = "application/http;msgtype=response"
    else:
        content_type = record.content_type
    lines = [
        WARC_VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {warc_id(f'{kind} {source_id}', record, payload_digest)}",
        f"WARC-Date: {timestamp(record.date)}",
        f"WARC-Target-URI: {_field(record.url)}",
        f"WARC-IP-Address: {record.ip}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Block-Digest: sha1:{payload_digest if block == payload else digest(block)}",
        f"WARC-Identified-Payload-Type: {record.content_type}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if source_id is not None:
        lines.append(f"WARC-Source-Id: {source_id}")
    if refers_to:
        target, date, other = refers_to
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Target-URI: {_field(target)}", f"WARC-Refers-To-Date: {date}"]
        if other is not None:
            lines.append(f"WARC-Refers-To-Source-Id: {other}")
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def parse_warc(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of records, from the pieces of files that were cut at every END.

    Blocks may hold an END, or end with half of one, so the cuts are undone and only declared lengths count. A file
    that stops inside a record is an error.
    """
    buffer = bytearray()
    head: dict[str, str] | None = None
    start = need = 0
    for piece in pieces:
        buffer += piece
        buffer += END
        while True:
            if head is None:
                blank = len(buffer) - len(buffer.lstrip(b"\r\n"))
                del buffer[:blank]
                at = buffer.find(END)
                if at < 0:
                    break
                lines = buffer[:at].decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
                head = dict(line.split(": ", 1) for line in lines[1:])
                start = at + len(END)
                need = start + int(head["Content-Length"])
            if len(buffer) < need + len(END):
                break
            yield head, bytes(buffer[start:need])
            del buffer[: need + len(END)]
            head = None
    if head is not None or buffer.strip(b"\r\n"):
        raise ValueError("the file ends inside a record")


def to_arc(pages: DataFrame, version: int = 1, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(source_id, arc, version): pages as ARC URL records with an HTTP response as their block.

    A null page is an empty payload, a null URL a hyphen. The date is a constant, for pages have none.
    """
    schema = "source_id bigint, arc binary, version int"

    def run(batches):
        target = arrow_schema(schema)
        for batch in batches:
            ids, urls, bodies = (batch.column(i).to_pylist() for i in range(3))
            arcs = []
            for link, body in zip(urls, bodies):
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                record = ArcRecord(link or "-", "0.0.0.0", "20200101000000", "text/html", head.encode() + body, "200")
                arcs.append(arc_record(version, record))
            columns = [ids, arcs, [version] * len(ids)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, target)], schema=target)

    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(F.col(key).cast("bigint"), F.col(url).cast("string"), body).mapInArrow(run, schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, arc, version) of ARC files, one row per file that Spark reads whole; ids are null."""
    files = spark.read.format("binaryFile").load(path)

    def run(batches):
        import gzip

        for batch in batches:
            for data in batch.column(0).to_pylist():
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None], pa.int64()), pa.array([data], pa.binary()), pa.array([None], pa.int32())],
                    names=["source_id", "arc", "version"],
                )

    return files.select("content").mapInArrow(run, "source_id bigint, arc binary, version int")


def records(arcs: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per ARC record: source_id, its header fields, HTTP head, payload, payload_digest and payload_bytes."""
    schema = (
        "source_id bigint, url string, ip string, date string, content_type string, head binary, payload binary, "
        "payload_digest string, payload_bytes bigint"
    )

    def run(batches):
        target = arrow_schema(schema)
        held, size = [], 0
        for batch in batches:
            for key, data, version in zip(*(batch.column(n).to_pylist() for n in ("source_id", "arc", "version"))):
                for r in parse_arc(data, version):
                    head, payload = payload_of(r)
                    sent = (head, payload) if with_payload else (None, None)
                    held.append((key, r.url, r.ip, r.date, r.content_type, *sent, digest(payload), len(payload)))
                    size += len(r.block)
                    if size >= BATCH_BYTES:
                        yield _batch(held, target)
                        held, size = [], 0
        if held:
            yield _batch(held, target)

    return arcs.mapInArrow(run, schema)


def _batch(rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(target)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, target)], schema=target)


def write_warc(arcs: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Convert ARC records and write them as gzip WARC files below ``path``.

    Of records with equal payloads of ``least_bytes`` or more, the one with the smallest source id is a response and
    the others revisit it; null ids come last. Rows that share that smallest id are all responses.
    """
    order = F.struct(F.col("source_id").isNull().alias("n"), "source_id", "date", "url")
    # As a table: it is read by a join, which broadcasts it if it is small and splits a frequent digest if not.
    repeated = stage(
        records(arcs, with_payload=False)
        .filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select("payload_digest", F.lit(True).alias("_known"), *(F.col(f"_first.{n}").alias(f"_{n}") for n in ("source_id", "url", "date"))),
        "repeated-payloads",
    )
    schema = "record binary"

    def run(batches):
        target = arrow_schema(schema)
        for batch in batches:
            out = []
            for key, url, ip, date, kind, head, payload, code, _, known, first, target_url, target_date in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                refers = (target_url, timestamp(target_date), first) if known and key != first else None
                out.append((warc_record(ArcRecord(url, ip, date, kind, b""), head, payload, code, key, refers),))
            yield _batch(out, target)

    joined = records(arcs).join(repeated, "payload_digest", "left").select(
        "source_id", "url", "ip", "date", "content_type", "head", "payload", "payload_digest", "payload_bytes",
        "_known", "_source_id", "_url", "_date",
    )
    text = joined.mapInArrow(run, schema).select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record below ``path``: source_id, its main headers, and the payload's digest as it is read.

    ``payload_bytes`` and ``payload_digest`` of a revisit are those declared; a response whose payload does not
    have its declared digest fails.
    """
    schema = (
        "source_id bigint, record_id string, record_type string, date string, url string, payload_bytes bigint, "
        "payload_digest string, refers_to bigint, payload binary"
    )

    def run(batches):
        target = arrow_schema(schema)
        held, size = [], 0
        for head, block in parse_warc(piece for batch in batches for piece in batch.column(0).to_pylist()):
            declared, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
            payload = None
            if kind != "revisit":
                http = head["Content-Type"].startswith("application/http")
                payload = block[head_size(block) :] if http else block
                if digest(payload) != declared:
                    raise ValueError(f"{head['WARC-Record-ID']}: the payload is not the one declared")
            row = (
                _number(head, "WARC-Source-Id"), head["WARC-Record-ID"], kind, head["WARC-Date"], head["WARC-Target-URI"],
                int(head["WARC-Payload-Length"]), declared, _number(head, "WARC-Refers-To-Source-Id"), payload,
            )
            held.append(row)
            size += len(block)
            if size >= BATCH_BYTES:
                yield _batch(held, target)
                held, size = [], 0
        if held:
            yield _batch(held, target)

    # A gzip file is read by one task, from its begin to its end.
    pieces = spark.read.option("lineSep", END.decode()).text(path)
    return pieces.select(F.col("value").cast("binary")).mapInArrow(run, schema)


def _number(head: dict[str, str], name: str) -> int | None:
    return int(head[name]) if name in head else None


def archived(pages: DataFrame, key: str = "page_id", version: int = 1, least_bytes: int = 0, **columns) -> DataFrame:
    """Pages as ARC records, converted, written as WARC files to the shared folder, and read back.

    Per page: the key, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``. Every row makes a
    record, repeated rows too; null ids and pages are those of ``to_arc``. An empty table makes no record.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(to_arc(pages, version, key, **columns), path, least_bytes)
    read = read_warc(spark, path)
    return read.select(
        F.col("source_id").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
