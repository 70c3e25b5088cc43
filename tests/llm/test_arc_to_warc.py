from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from conftest import SF

from wardlens.functions.scale import new_path
from wardlens.llm import arc_to_warc as arc

SCHEMA = "page_id long, url string, html string, digest string, payload binary, name string"


def key(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def brute(rows, min_bytes):
    payloads = [(r.page_id, (r.html or "").encode()) for r in rows]
    best = {}
    for i, b in payloads:
        if i is not None:
            best[b] = max(best.get(b, i), i)
    out = []
    for i, b in payloads:
        revisit = len(b) >= min_bytes and b in best and best[b] != i
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, "revisit" if revisit else "response", best[b] if revisit else None))
    return out


def pages(spark):
    rows = [
        (1, "http://a/", "<p>same</p>"), (2, "http://b/ x\ny", "<p>same</p>"), (3, None, None), (4, "", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"),
        (6, "u", "é\r\n\r\nWARC/1.1\r\n"), (7, "http://h/", "HTTP/1.1 404\r\n\r\nnot a head"), (None, "n", "<p>same</p>"), (None, "n", "alone"),
        (8, "big", "x" * 400_000), (9, "big", "x" * 400_000), (10, "t", "tiny"), (11, "t", "tiny"), (11, "t", "tiny"), (12, "s", "\x00 "),
    ]
    return spark.createDataFrame([(*r, "d", b"p", "n") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("min_bytes", [0, 12])
def test_round_trip(spark, min_bytes):
    df = pages(spark)
    got = arc.pages_through_archives(df, min_bytes).collect()
    assert key(got) == key(brute(df.collect(), min_bytes))


def test_fixture(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert key(arc.pages_through_archives(df).collect()) == key(brute(df.collect(), 0))


def test_empty(spark):
    assert arc.pages_through_archives(pages(spark).limit(0)).count() == 0


def version_1(*records):
    return arc.arc_version_block(1, "f.arc") + b"".join(records)


def test_versions_blanks_and_members():
    body = arc.http_body(3, b"hello")
    for version in (1, 2):
        data = arc.arc_version_block(version, "f.arc") + arc.arc_record(version, "http://x/a b", body)
        members = gzip.compress(data[:40]) + gzip.compress(data[40:])
        for content in (data, gzip.compress(data), members):
            (record,) = arc.arc_records(content)
            assert record.url == "http://x/a b" and record.date == arc.ARC_DATE and record.body == body
            assert arc.split_http(record.body)[1] == b"hello"
    (record,) = arc.arc_records(version_1(b"http://x/ 1.2.3.4 19970102030405 image/gif 3\nGIF\n"))
    assert (record.address, arc.warc_date(record.date), record.content_type) == ("1.2.3.4", "1997-01-02T03:04:05Z", "image/gif")
    assert arc.split_http(record.body) == (b"", b"GIF")


@pytest.mark.parametrize(
    "content",
    [b"no header\n", version_1(b"http://x/ 1.2.3.4 19970102030405 a 30\nshort\n"), b"filedesc://f 0 0 t 4\nabc\n\n", gzip.compress(b"x" * 99)[:-9]],
)
def test_malformed_archives_are_named(content):
    with pytest.raises(ValueError):
        list(arc.arc_records(content, "broken.arc"))


def test_written_archives_are_warc(spark):
    records = arc.with_record_types(arc.convert_archives(arc.arc_archives(pages(spark))))
    path = new_path(spark, "warc-test")
    arc.write_warc(records, path)
    found = []
    for row in spark.read.format("binaryFile").load(path).collect():
        assert row.path.endswith(".gz")
        found += list(arc.warc_records(row.content))
    kinds = [fields["WARC-Type"] for fields, _ in found]
    assert kinds.count("response") + kinds.count("revisit") == 15 and kinds[0] == "warcinfo"
    ids = {f["WARC-Record-ID"] for f, _ in found if f["WARC-Type"] == "response"}
    for fields, block in found:
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To"] in ids and fields["WARC-Profile"] == arc.PROFILE
            assert block.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(block)
