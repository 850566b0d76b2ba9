"""Conversion of ARC web archives (the format before WARC), writing WARC archives, and reading them back.

ARC: every record is one header line of space-separated fields, the last of which is the body's length,
then the body. The first record describes the file; its body names the version and the fields of the header
lines that follow. Version 1 has five fields, version 2 has ten. WARC: named header fields, a body of
declared length, two line ends; each record is a gzip member of its own, so a reader can start at any record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.text import slices
from tillhouse.session import work_dir

#: The field names of the two versions' header lines.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
#: Bytes of bodies after which a new archive is begun.
ARCHIVE = 128 << 10
#: Records in one written file at most.
FILE_RECORDS = 1024
#: Revisits are made of payloads of at least so many bytes.
REVISIT_FROM = 0
ORIGIN = "Tillhouse"
PAGE_FIELD = "X-Page-Id"
#: A gzip member without content. It stands between the records' members and reads as nothing.
NOTHING = gzip.compress(b"", mtime=0)
LEVEL = 4


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes) -> bytes:
    return gzip.compress(data, LEVEL, mtime=0)


# ---- ARC: writing (to have legacy archives of the pages) ----


def _line(version: int, url: str, ip: str, date: str, kind: str, code: str, offset: int, name: str, length: int) -> bytes:
    values = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Result-code": code, "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(length)}
    return " ".join(values[f] for f in FIELDS[version]).encode()


def arc_file(version: int, name: str, records: list[tuple[str, str, str, str, bytes]]) -> bytes:
    """An archive of (url, ip, 14-digit date, content type, body) records."""
    about = f"{version} 0 {ORIGIN}\n{' '.join(FIELDS[version])}\n".encode()
    date = records[0][2] if records else "19960101000000"
    out = bytearray(_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", "200", 0, name, len(about)) + b"\n" + about)
    for url, ip, when, kind, body in records:
        code = body[9:12].decode("latin-1") if body.startswith(b"HTTP/") else "-"
        out += b"\n"
        out += _line(version, url, ip, when, kind, code, len(out), name, len(body)) + b"\n" + body
    return bytes(out + b"\n")


def page_body(page_id: int | None, html: bytes) -> bytes:
    """An HTTP response that carries the page and its id."""
    own = f"{PAGE_FIELD}: {page_id}\r\n" if page_id is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(html)}\r\n\r\n".encode() + html


def arc_url(url: str | None) -> str:
    """The address without characters that would break a header line; a missing one has a placeholder."""
    url = "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in (url or "").encode("utf-8", "replace")).encode("latin-1").decode("utf-8", "replace")
    return url or "urn:unknown"


def to_arc(pages: DataFrame, date: str = "20010101000000") -> DataFrame:
    """ARC archives (``name``, ``content``) of the rows' ``page_id``, ``url`` and ``html``; a hash of its first record tells an archive's version."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = 0, [], 0

        def flush() -> pa.RecordBatch:
            version = 1 + (zlib.crc32(held[0][4]) >> 8) % 2
            name = f"pages-{number}-v{version}.arc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_file(version, name, held)], pa.binary())], ["name", "content"])

        for batch in slices(batches, 64):
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                body = page_body(page_id, html or b"")
                held.append((arc_url(url), "127.0.0.1", date, "text/html", body))
                size += len(body)
                if size >= ARCHIVE:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    return pages.select("page_id", "url", F.col("html").cast("binary").alias("html")).mapInArrow(each, "name string, content binary")


# ---- ARC: parsing ----


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    body: bytes
    describes: bool  # the archive itself


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of an archive, the file's description first. Bodies are taken by their declared length alone."""
    at, version = 0, 0
    while True:
        while at < len(content) and content[at] in b"\r\n":
            at += 1
        if at >= len(content):
            return
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no end of the header line at byte {at}")
        line = content[at:end].rstrip(b"\r").decode("utf-8", "replace")
        length = int(line.rpartition(" ")[2])
        body = content[end + 1 : end + 1 + length]
        if len(body) < length:
            raise ValueError(f"the record at byte {at} is cut off: {len(body)} of {length} bytes")
        describes = not version
        if describes:
            if not line.startswith("filedesc://"):
                raise ValueError("the archive doesn't begin with its description")
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} is not known")
        names = FIELDS[version]
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"{len(values)} fields in a version {version} header line at byte {at}")
        yield ArcRecord(version, dict(zip(names, values, strict=True)), body, describes)
        at = end + 1 + length


def iso_date(date: str) -> str:
    """A 14-digit date, or a shorter one that ARC writers left incomplete, as WARC writes it."""
    full = date + "19960101000000"[len(date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def http_split(body: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload of an HTTP response; other bodies are payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, blank, payload = body.partition(b"\r\n\r\n")
    return (head + blank, payload) if blank else (b"", body)


def http_field(head: bytes, name: str) -> str | None:
    for line in head.decode("latin-1").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        if key.strip().lower() == name.lower():
            return value.strip()
    return None


def warc_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.0\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


RECORDS = (
    "kind string, record_id string, page_id long, uri string, date string, ip string, head binary, "
    "payload_bytes long, payload_digest string, member binary"
)


def convert_record(record: ArcRecord, name: str, members: bool = True) -> dict:
    """The WARC record that says the same, with an id that follows from what is archived.

    A file's description becomes ``warcinfo``, an HTTP response ``response``, anything else ``resource``.
    """
    f = record.fields
    uri, date = f["URL"], iso_date(f["Archive-date"])
    if record.describes:
        kind, content_type, head, payload = "warcinfo", "application/warc-fields", b"", f"software: {ORIGIN}\r\nformat: WARC File Format 1.0\r\nconverted-from: ARC version {record.version}, {name}\r\n".encode()
    else:
        head, payload = http_split(record.body)
        kind, content_type = ("response", "application/http; msgtype=response") if head else ("resource", f["Content-type"])
    digest, page = sha1(payload), http_field(head, PAGE_FIELD)
    record_id = f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {page} {digest}').urn}>"
    whole = None
    if members:
        whole = member(_as_warc(kind, record_id, date, uri, f["IP-address"], digest, content_type, head + payload))
    return {
        "kind": kind,
        "record_id": record_id,
        "page_id": int(page) if page is not None else None,
        "uri": uri,
        "date": date,
        "ip": f["IP-address"],
        "head": head,
        "payload_bytes": len(payload),
        "payload_digest": digest,
        "member": whole,
    }


def _as_warc(kind: str, record_id: str, date: str, uri: str, ip: str, digest: str, content_type: str, block: bytes) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", content_type)]
    if kind != "warcinfo":
        fields[3:3] = [("WARC-Target-URI", uri), ("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha1:{digest}")]
    return warc_bytes(fields, block)


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    spec = [c.split() for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in spec], [n for n, _ in spec])


def convert(archives: DataFrame, members: bool = True) -> DataFrame:
    """WARC records of ARC archives (``name``, ``content``); ``member`` is the whole record, compressed, or null."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            name, content = batch.column("name")[0].as_py(), batch.column("content")[0].as_py()
            rows: list[dict] = []
            for record in parse_arc(content or b"") if content else ():
                rows.append(convert_record(record, name, members))
                if len(rows) >= 256:
                    yield _record_batch(rows)
                    rows = []
            if rows:
                yield _record_batch(rows)

    return archives.select("name", "content").mapInArrow(each, RECORDS)


# ---- WARC ----


def mark_revisits(records: DataFrame, revisit_from: int = REVISIT_FROM, slim: DataFrame | None = None) -> DataFrame:
    """Adds ``first``: of responses with one payload, the record of the smallest page id, null for that record itself.

    Payloads are compared by digest and length. The smallest id is found by a pre-aggregated minimum, and
    the join's other side has one row per payload, so a payload that many pages share can be split freely.
    ``slim`` may give the same records without their members, to find the firsts from.
    """
    large = (F.col("kind") == "response") & (F.col("payload_bytes") >= revisit_from)
    firsts = (
        (records if slim is None else slim).filter(large & F.col("page_id").isNotNull())
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min(F.struct("page_id", "record_id", "uri", "date")).alias("first"))
    )
    other = large & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first.page_id")))
    return records.join(firsts, ["payload_digest", "payload_bytes"], "left").withColumn("first", F.when(other, F.col("first")))


def _revisit(row: dict) -> bytes:
    first = row["first"]
    fields = [
        ("WARC-Type", "revisit"),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["uri"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
        ("WARC-Refers-To", first["record_id"]),
        ("WARC-Refers-To-Target-URI", first["uri"]),
        ("WARC-Refers-To-Date", first["date"]),
        (f"WARC-Refers-To-{PAGE_FIELD}", str(first["page_id"])),
        ("WARC-Truncated", "length"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return member(warc_bytes(fields, row["head"]))


def write_warc(records: DataFrame, path: str) -> None:
    """Write marked records: a revisit holds the HTTP head only.

    Spark's text writer puts the members into files as they are, so any store that Spark can write will do; the
    empty member serves as its line end.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            whole = batch.column("member").to_pylist()
            for k, first in enumerate(batch.column("first").to_pylist()):
                if first is not None:
                    whole[k] = _revisit(batch.slice(k, 1).to_pylist()[0])
            yield pa.RecordBatch.from_arrays([pa.array(whole, pa.binary())], ["value"])

    empty = F.when(F.col("first").isNull(), F.col("member")).alias("member")
    slim = records.select("record_id", "page_id", "uri", "date", "ip", "head", "payload_digest", empty, "first")
    (
        slim.mapInArrow(each, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", NOTHING.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:20]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"a record is cut off: {len(block)} of {length} bytes")
        yield fields, block


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def page_of(fields: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """What a response or revisit says about its page. A response's payload is measured and its digest verified."""
    head, payload = http_split(block)
    page, digest = http_field(head, PAGE_FIELD), fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        size = int(http_field(head, "Content-Length") or 0)
    else:
        size = len(payload)
        if sha1(payload) != digest:
            raise ValueError(f"{fields['warc-record-id']}: the payload doesn't have the digest {digest}")
    refers = fields.get(f"warc-refers-to-{PAGE_FIELD}".lower())
    return int(page) if page is not None else None, size, digest, fields["warc-type"], int(refers) if refers is not None else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit of the archives under ``path``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in PAGES.split(", ")]
        for batch in slices(batches, 1):
            with gzip.GzipFile(fileobj=io.BytesIO(batch.column("content")[0].as_py())) as f:
                rows = [page_of(fields, block) for fields, block in parse_warc(io.BufferedReader(f)) if fields["warc-type"] in ("response", "revisit")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(each, PAGES)


def archive_pages(pages: DataFrame, revisit_from: int = REVISIT_FROM, path: str | None = None) -> DataFrame:
    """Pages to legacy archives, those to WARC archives under ``path``, and back: one row per page.

    Needs ``page_id``, ``url`` and ``html``. A null html is an empty payload, a null url gets a placeholder. A page
    without an id is never what others refer to. Rows that repeat the smallest id of a payload are responses
    like it. An empty table writes no records and gives no rows. Pages are converted twice, once for the digests
    alone, which costs less than a stored copy; one compressed copy is shuffled, one written.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark)
    archives = to_arc(pages)
    write_warc(mark_revisits(convert(archives), revisit_from, convert(archives, members=False)), path)
    return read_warc(spark, path)
