"""Conversion of legacy ARC archives to WARC archives, and reading those back.

An ARC archive opens with a version block whose second line names the version and whose third names the fields of
every record's header line: five in version 1, ten in version 2. A record is that line, as many bytes as it declares, and a
line feed. The converter takes the fields from the right, as old crawlers left blanks in URLs, and the body by its
declared length, and makes the WARC record that a crawler would have written: type, date, target, address, payload
digest, and an identifier derived from page, target, date and digest, so a rerun gives the same archive.

Of records with equal payloads of at least ``min_bytes`` the one with the largest page id is the response and
the others are revisits that refer to it and keep only the HTTP head. Winners are an aggregate per digest; only those of
repeated payloads are joined back, streaming the records, so a hot payload can be split. Archives are written by
Spark's text writer, whose line separator is the end of a record, gzip-compressed, and read whole as binary files.

Cases: a null html is an empty payload; a null url becomes ``urn:unknown``, and blanks and control characters in one are
percent-encoded; a row without page id has no id header and comes back without one, and wins only among such rows; rows that
repeat the winning page id and payload are all responses; other columns are ignored; empty tables give empty
archives. A truncated or malformed archive raises an error that names it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize, new_path
from wardlens.llm.exchange import text_batches
from wardlens.llm.shipping import ship_package

MIN_BYTES = 0
ARC_DATE = "20000101000000"
ARC_ADDRESS = "0.0.0.0"
PAGE_HEADER = b"X-Page-Id"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the ARC format: the field names of each version.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def unpacked_archive(content: bytes) -> bytes:
    """The archive's bytes; gzip members, one or many, are inflated."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        inflate = zlib.decompressobj(31)
        parts.append(inflate.decompress(content) + inflate.flush())
        if not inflate.eof:
            raise ValueError("truncated gzip member")
        content = inflate.unused_data
    return b"".join(parts)


def encoded_url(url: str | None) -> str:
    if not url:
        return "urn:unknown"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def arc_record(version: int, url: str, body: bytes, name: str = "-", offset: int = 0) -> bytes:
    fields = [url, ARC_ADDRESS, ARC_DATE, "text/html"]
    if version == 2:
        fields += ["200", "-", "-", str(offset), name]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} {ARC_ADDRESS} {ARC_DATE} text/plain{extra} {len(body)}\n".encode() + body + b"\n"


def http_body(page_id: int | None, payload: bytes) -> bytes:
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"]
    if page_id is not None:
        head.append(PAGE_HEADER + b": " + str(page_id).encode())
    head.append(b"Content-Length: " + str(len(payload)).encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + payload


def _archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One ARC archive per batch, versions 1 and 2 in turn."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in text_batches(batches):
        version, name = 1 + number % 2, f"pages-{part:05d}-{number:05d}.arc"
        number += 1
        parts, size = [arc_version_block(version, name)], 0
        for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            size += len(parts[-1])
            body = http_body(page_id, (html or "").encode("utf-8", "surrogatepass"))
            parts.append(arc_record(version, encoded_url(url), body, name, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([b"".join(parts)], pa.binary())], names=["name", "content"]
        )


def arc_archives(pages: DataFrame) -> DataFrame:
    """(name, content): the pages as ARC archives."""
    ship_package(pages.sparkSession)
    read = pages.select(
        F.col("`page_id`").cast("long").alias("page_id"), F.col("`url`").cast("string").alias("url"),
        F.col("`html`").cast("string").alias("html"),
    )
    return read.mapInArrow(_archives, "name string, content binary")


@dataclass(frozen=True)
class ArcRecord:
    url: str
    address: str
    date: str
    content_type: str
    body: bytes


def arc_records(content: bytes, name: str = "") -> Iterator[ArcRecord]:
    """The records of one archive, by its version's header line and the declared lengths."""
    data = unpacked_archive(content)
    at, version = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        fields = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").split(" ")
        count = len(ARC_FIELDS[version or (2 if len(fields) >= 10 else 1)].split())
        if end < 0 or len(fields) < count or not fields[-1].isdigit():
            raise ValueError(f"{name}: no ARC header line at byte {at}")
        body = data[end + 1 : end + 1 + int(fields[-1])]
        if len(body) < int(fields[-1]):
            raise ValueError(f"{name}: truncated record at byte {at}")
        at = end + 1 + len(body) + 1
        if version is None:
            lines = body.split(b"\n")
            if not lines[0].split(b" ")[0].isdigit() or int(lines[0].split(b" ")[0]) not in ARC_FIELDS:
                raise ValueError(f"{name}: no ARC version block")
            version = int(lines[0].split(b" ")[0])
            continue
        rest = fields[len(fields) - count + 1 :]
        yield ArcRecord(" ".join(fields[: len(fields) - count + 1]), rest[0], rest[1], rest[2], body)


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its closing blank line, and payload; a body without a head is all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, blank, payload = body.partition(b"\r\n\r\n")
    return head + blank, payload


def http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower():
            return value.strip().decode()
    return None


def warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


_RECORD_DDL = (
    "record_id string, page_id long, url string, address string, date string, content_type string, "
    "digest string, payload_bytes long, head binary, payload binary"
)
_RECORD_KINDS = (
    pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(),
    pa.binary(),
)
_RECORD_NAMES = [f.split(" ")[0] for f in _RECORD_DDL.split(", ")]


def _convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
            out = []
            for r in arc_records(content.as_py(), name):
                head, payload = split_http(r.body)
                page, date, digest = http_field(head, PAGE_HEADER), warc_date(r.date), payload_digest(payload)
                key = uuid.uuid5(uuid.NAMESPACE_URL, f"{r.url} {date} {page} {digest}")
                out.append((
                    f"<urn:uuid:{key}>", int(page) if page else None, r.url, r.address, date, r.content_type, digest,
                    len(payload), head, payload,
                ))
            columns = list(zip(*out)) if out else [()] * len(_RECORD_NAMES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _RECORD_KINDS)], names=_RECORD_NAMES
            )


def convert_archives(archives: DataFrame) -> DataFrame:
    """The records of ARC archives (name, content) with synthesised WARC fields."""
    ship_package(archives.sparkSession)
    return archives.mapInArrow(_convert, _RECORD_DDL)


def with_record_types(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Adds refers_to and refers_to_url, null for responses."""
    rows = records.select("digest", "payload_bytes", "page_id", "record_id", "url").where(
        F.col("payload_bytes") >= min_bytes
    )
    front = F.max(F.struct("page_id", "record_id", "url"))
    winners = rows.groupBy("digest", "payload_bytes").agg(front.alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = records.join(winners.drop("n"), ["digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    return joined.select(
        *_RECORD_NAMES, F.when(revisit, F.col("first.record_id")).alias("refers_to"),
        F.when(revisit, F.col("first.url")).alias("refers_to_url"),
    )


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its closing ``END``."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def _warc_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of a partition, which becomes one archive, after a warcinfo record."""
    first = True
    for batch in text_batches(batches):
        out = []
        if first:
            about = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo {TaskContext.get().partitionId()}")
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{about}>")]
            info += [("WARC-Date", warc_date(ARC_DATE)), ("Content-Type", "application/warc-fields")]
            out.append(warc_record(info, b"format: WARC File Format 1.1\r\n"))
            first = False
        for r in batch.to_pylist():
            revisit = r["refers_to"] is not None
            fields = [
                ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", r["record_id"]),
                ("WARC-Date", r["date"]), ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["address"]),
                ("WARC-Payload-Digest", "sha1:" + r["digest"]),
                ("Content-Type", "application/http; msgtype=response" if r["head"] else r["content_type"]),
            ]
            if revisit:
                fields += [
                    ("WARC-Profile", PROFILE), ("WARC-Refers-To", r["refers_to"]),
                    ("WARC-Refers-To-Target-URI", r["refers_to_url"]),
                ]
            out.append(warc_record(fields, r["head"] if revisit else r["head"] + r["payload"]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_warc(records: DataFrame, path: str) -> None:
    """Write typed records as gzip-compressed WARC archives, one per partition."""
    lines = records.mapInArrow(_warc_lines, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


def warc_records(content: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, by declared lengths."""
    data, at, end = unpacked_archive(content), 0, END.encode()
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{name}: no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        block = data[stop + 4 : stop + 4 + length]
        at = stop + 4 + length + len(end)
        if data[at - len(end) : at] != end:
            raise ValueError(f"{name}: record does not end at byte {at}")
        yield fields, block


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "record_type", "page_id", "url", "date", "payload_bytes", "payload_digest", "refers_to"]
    kinds = (
        pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()
    )
    for batch in batches:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            out = []
            for fields, block in warc_records(content.as_py(), name):
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                head, payload = split_http(block)
                page, digest = http_field(head, PAGE_HEADER), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = len(payload) if kind == "response" else int(http_field(head, b"Content-Length") or 0)
                if kind == "response" and payload_digest(payload) != digest:
                    raise ValueError(f"{name}: {fields['WARC-Record-ID']} does not match its digest")
                out.append((
                    fields["WARC-Record-ID"], kind, int(page) if page else None, fields["WARC-Target-URI"],
                    fields["WARC-Date"], size, digest, fields.get("WARC-Refers-To"),
                ))
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit record of the archives under ``path``."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(
        _read,
        "record_id string, record_type string, page_id long, url string, date string, payload_bytes long, "
        "payload_digest string, refers_to string",
    )


def pages_through_archives(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages to ARC, ARC to WARC, and back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    converted, path = new_path(spark, "arc-records"), new_path(spark, "warc")
    convert_archives(arc_archives(pages)).write.option("compression", "zstd").parquet(converted)
    records = spark.read.schema(_RECORD_DDL).parquet(converted)
    write_warc(with_record_types(records, min_bytes), path)
    back = materialize(read_warc(spark, path), "warc-records")
    responses = back.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("response")
    )
    cited = responses.join(back.select("refers_to").distinct(), "refers_to", "left_semi").distinct()
    return back.join(cited, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("response").alias("refers_to")
    )
