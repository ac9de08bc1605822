"""Conversion of ARC archives to WARC, and back again to rows.

``arc_archives`` writes pages as ARC archives, each with a version block and one gzip member per record. ``convert_arc``
parses the version-specific header lines and declared lengths and synthesises what WARC records need: identifiers,
timestamps, types and digests. ``with_revisits`` finds equal payloads, ``write_warc`` writes WARC files with Spark's text
writer (a record's end mark is its line separator), ``read_warc`` reads them by declared length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import written

# The fields of a header line by version, and the WARC names used.
ARC_FIELDS = {
    1: ("url", "ip", "date", "content_type", "length"),
    2: ("url", "ip", "date", "content_type", "result", "checksum", "location", "offset", "filename", "length"),
}
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"

CAPTURED = "20200101000000"
ARCHIVE_BYTES = 4 << 20
RECORDS_PER_FILE = 2000


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _arc_line(version: int, name: str, offset: int, url: str, kind: str, body: bytes, date: str) -> bytes:
    known = {"url": url, "ip": "0.0.0.0", "date": date, "content_type": kind, "result": "200", "checksum": "-"}
    known |= {"location": "-", "offset": str(offset), "filename": name, "length": str(len(body))}
    return (" ".join(known[f] for f in ARC_FIELDS[version]) + "\n").encode("utf-8") + body + b"\n"


def _url(url: str | None) -> str:
    """A header line has no blanks in its fields."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or "unknown:"


def arc_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = CAPTURED,
) -> DataFrame:
    """``name`` and ``content`` of ARC archives of about ``archive_bytes`` before compression, version 1 and 2 in turn.

    Each page is an HTTP response; its id is a header of that. A null or empty page has an empty payload, a null id no
    header, a null url the url ``unknown:``. Row-local: a task holds one archive.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, members, size = TaskContext.get().partitionId(), 0, [], 0

        def finished() -> pd.DataFrame:
            return pd.DataFrame({"name": [f"pages-{part:05d}-{number:05d}.arc.gz"], "content": [b"".join(members)]})

        for batch in batches:
            for page, url, html in zip(batch["id"], batch["url"], batch["html"]):
                version, name = 1 + number % 2, f"pages-{part:05d}-{number:05d}.arc.gz"
                if not members:
                    block = f"{version} 0 archive\n{ARC_TITLES[version]}\n".encode("ascii")
                    members = [gzip.compress(_arc_line(version, name, 0, f"filedesc://{name}", "text/plain", block, date), 6)]
                body = ("" if html is None else html).encode("utf-8", "surrogatepass")
                own = "" if page is None else f"X-Page-Id: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{own}\r\n"
                record = _arc_line(version, name, size, _url(url), "text/html", head.encode("ascii") + body, date)
                members.append(gzip.compress(record, 6, mtime=0))
                size += len(record)
                if size >= archive_bytes:
                    yield finished()
                    number, members, size = number + 1, [], 0
        if members:
            yield finished()

    only = pages.select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    return only.mapInPandas(write, "name string, content binary")


def _members(content: bytes) -> Iterator[bytes]:
    """The members of a gzip file one by one; an uncompressed archive as a whole."""
    if not content.startswith(b"\x1f\x8b"):
        yield content
        return
    while content:
        unpack = zlib.decompressobj(wbits=31)
        yield unpack.decompress(content) + unpack.flush()
        content = unpack.unused_data


def parse_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and body of each record after the version block, which says what the header lines hold.

    Raises ``ValueError`` for an unknown version, a header line with too few fields or a body shorter than declared."""
    fields, at = None, 0
    for member in _members(content):
        at = 0
        while at < len(member):
            if member[at : at + 1] in (b"\n", b"\r"):  # between records
                at += 1
                continue
            end = member.find(b"\n", at)
            line = member[at : end if end >= 0 else len(member)].decode("utf-8", "replace").rstrip("\r")
            length = line.rsplit(" ", 1)[-1]
            if end < 0 or not length.isdigit():
                raise ValueError(f"no ARC header line: {line[:80]!r}")
            body = member[end + 1 : end + 1 + int(length)]
            if len(body) < int(length):
                raise ValueError(f"an ARC record ends before its declared length: {line[:80]!r}")
            at = end + 1 + int(length)
            if fields is None:
                version = int(body[:1]) if body[:1].isdigit() else 0
                if version not in ARC_FIELDS:
                    raise ValueError(f"not an ARC version block: {line[:80]!r}")
                fields = ARC_FIELDS[version]
                continue
            values = line.rsplit(" ", len(fields) - 1)
            if len(values) < len(fields):
                raise ValueError(f"too few fields in an ARC header line: {line[:80]!r}")
            yield dict(zip(fields, values)), body


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


RECORD_SCHEMA = (
    "record_id string, warc_type string, target_uri string, ip string, warc_date string, page string,"
    " payload_digest string, payload_bytes long, head binary, payload binary"
)


def convert_arc(archives: DataFrame) -> DataFrame:
    """WARC records of ARC archives (``name``, ``content``), in the columns of ``RECORD_SCHEMA``.

    The identifier depends on the archive's name and the record's number in it, so a retried task makes the same. An
    HTTP response has the type ``response`` and its payload is its body, anything else is a ``resource``. The 14-digit
    date (shorter ones are filled up) becomes an instant. An archive without records gives none; a damaged one raises.
    """

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                rows = []
                for number, (header, body) in enumerate(parse_arc(content or b"")):
                    http = body.startswith(b"HTTP/") and b"\r\n\r\n" in body
                    head, payload = body.split(b"\r\n\r\n", 1) if http else (b"", body)
                    d = (header["date"] + "00000101000000"[len(header["date"]) :])[:14]
                    rows.append(
                        (
                            f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{number}')}>",
                            "response" if http else "resource",
                            header["url"],
                            header["ip"],
                            f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                            _headers(head).get("x-page-id"),
                            digest_of(payload),
                            len(payload),
                            head,
                            payload,
                        )
                    )
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD_SCHEMA.split(", ")])

    return archives.select("name", "content").mapInPandas(convert, RECORD_SCHEMA)


def with_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with ``refers_to`` and ``refers_to_page``: of those with equal payloads of at least ``min_bytes`` the
    one with the largest page number (then the largest identifier; no number is the smallest) stays as it is, the others
    refer to it.

    Payloads are equal if digest and length are. One row per payload is left of a group before it is joined; only
    identifiers take part, and Spark splits the partitions of payloads with many copies. ``records`` must give the same
    rows each time it is read.
    """
    keys = written(
        records.where(F.col("payload_bytes") >= min_bytes).select(
            "record_id", F.col("page").cast("long").alias("number"), "payload_digest", "payload_bytes"
        ),
        "warc-keys",
    )
    firsts = keys.groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("number", "record_id")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = written(firsts.where("n > 1").select("payload_digest", "payload_bytes", "first"), "warc-firsts")
    revisits = keys.join(firsts, ["payload_digest", "payload_bytes"]).where("record_id <> first.record_id")
    revisits = revisits.select(
        "record_id", F.col("first.record_id").alias("refers_to"), F.col("first.number").alias("refers_to_page")
    )
    return records.join(written(revisits, "warc-revisits"), "record_id", "left")


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def write_warc(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Gzip-compressed WARC 1.0 files at ``path``. A record with ``refers_to`` is a revisit: it keeps the HTTP headers
    and the digest of its payload but not the payload."""
    revisit = F.col("refers_to").isNotNull()
    head = F.when(F.octet_length("head") > 0, F.concat("head", F.lit(RECORD_END).cast("binary"))).otherwise(F.col("head"))
    block = F.when(revisit, head).otherwise(F.concat(head, "payload"))
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.col("warc_type"))),
        _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.col("warc_date")),
        _line("WARC-Target-URI", F.col("target_uri")),
        _line("WARC-IP-Address", F.col("ip")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.col("refers_to")),
        _line("X-Refers-To-Page", F.col("refers_to_page")),
        _line("Content-Type", F.when(F.octet_length("head") > 0, F.lit("application/http; msgtype=response"))),
        _line("Content-Length", F.octet_length("block")),
        F.lit("\r\n"),
    )
    text = F.concat(header.cast("binary"), F.col("block")).cast("string")
    records.withColumn("block", block).select(text.alias("value")).write.option("lineSep", RECORD_END).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", records_per_file).text(path)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields and block of each record, by declared length. Raises ``ValueError`` for a damaged record."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        raw = line
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            raw += line
        fields = _headers(raw)
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"a WARC record ends before its declared length: {fields.get('warc-record-id')}")
        yield fields, block


READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, page string, payload_digest string,"
    " payload_bytes long, refers_to string, refers_to_page string"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files at ``path``. A payload must have the digest its record names; of a revisit,
    length and digest are those of the payload it stands for. A task reads one file at a time, record by record."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                stream = io.BytesIO(content)
                packed = content.startswith(b"\x1f\x8b")
                rows = []
                for fields, block in parse_warc(gzip.GzipFile(fileobj=stream) if packed else stream):
                    http = fields.get("content-type", "").startswith("application/http")
                    head, payload = block.split(b"\r\n\r\n", 1) if http else (b"", block)
                    inner, digest = _headers(head), fields["warc-payload-digest"].removeprefix("sha1:")
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and digest_of(payload) != digest:
                        raise ValueError(f"a payload is not what its digest says: {fields['warc-record-id']}")
                    size = int(inner["content-length"]) if revisit else len(payload)
                    rows.append(
                        (
                            fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri"),
                            fields.get("warc-date"), inner.get("x-page-id"), digest, size,
                            fields.get("warc-refers-to"), fields.get("x-refers-to-page"),
                        )
                    )
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ_SCHEMA.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(read, READ_SCHEMA)
