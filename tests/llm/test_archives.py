from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from tillhouse.llm import arc
from tillhouse.llm.queries import QUERIES
from tillhouse.session import work_dir


def plain(pages, least=0):
    """(id, html) pairs as the query returns them."""
    first, out = {}, []
    for i, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, h in pages:
        raw = (h or "").encode()
        head = first.get(h or "")
        revisit = head is not None and i != head and len(raw) >= least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


def frame(spark, pages):
    rows = [(i, f"http://x.example/{i} a\n", h, "k", "f") for i, h in pages]
    return spark.createDataFrame(rows, "page_id long, url string, html string, kind string, first string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert rows(QUERIES["op8_legacy_archives"](spark, sf)) == plain(pages)


def test_small_tables_meet_both_versions(spark, sf):
    archives = arc.to_arc(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    assert {next(arc.parse_arc(a.content)).version for a in archives} == {1, 2}


def test_odd_pages(spark):
    tricky = "HTTP/1.1 200 OK\r\nX-Page-Id: 99\r\n\r\nhttp://a 1.1.1.1 20000101000000 text/html 5\nWARC/1.0\r\nWARC-Type: response\r\n\r\n"
    pages = [(5, "same"), (3, "same"), (9, "same"), (None, "same"), (7, None), (8, ""), (1, tricky), (2, "é中😀" * 70_000), (None, "alone"), (4, "\n\n"), (6, "\r\n\r\n"), (3, "same")]
    assert rows(arc.archive_pages(frame(spark, pages))) == plain(pages)
    assert rows(arc.archive_pages(frame(spark, pages), revisit_from=5)) == plain(pages, 5)


def test_empty_table_and_null_url(spark):
    assert arc.archive_pages(frame(spark, [])).collect() == []
    df = spark.createDataFrame([(1, None, "x")], "page_id long, url string, html string")
    assert arc.archive_pages(df).count() == 1


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions_by_declared_lengths(version):
    body = b"HTTP/1.1 404 Not Found\r\nServer: s\r\n\r\nline\nhttp://fake 1.2.3.4 20010203040506 text/html 3\nabc\n"
    content = arc.arc_file(version, "a.arc", [("http://a/", "1.2.3.4", "20010203040506", "text/html", body), ("dns:a", "5.6.7.8", "2002", "text/dns", b"")])
    about, page, dns = arc.parse_arc(content)
    assert about.describes and about.version == version and page.body == body and dns.body == b""
    assert list(page.fields) == arc.FIELDS[version] and page.fields.get("Result-code", "404") == "404"
    made = arc.convert_record(page, "a.arc")
    assert (made["kind"], made["date"], made["ip"]) == ("response", "2001-02-03T04:05:06Z", "1.2.3.4")
    ((fields, block),) = arc.parse_warc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(made["member"]))))
    assert block == body and fields["warc-target-uri"] == "http://a/" and int(fields["content-length"]) == len(body)
    assert fields["warc-block-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert made["record_id"] == arc.convert_record(page, "a.arc")["record_id"]
    assert arc.convert_record(dns, "a.arc")["kind"] == "resource" and arc.convert_record(dns, "a.arc")["date"] == "2002-01-01T00:00:00Z"
    assert arc.convert_record(about, "a.arc")["kind"] == "warcinfo"


@pytest.mark.parametrize("spoil", [lambda c: c[:-30], lambda c: c[5:], lambda c: c.replace(b"\n1 0 ", b"\n7 0 ")])
def test_broken_archives_are_refused(spoil):
    content = arc.arc_file(1, "a.arc", [("http://a/", "1.2.3.4", "20010203040506", "text/html", b"x" * 40)])
    with pytest.raises(ValueError):
        list(arc.parse_arc(spoil(content)))


def test_files_are_gzip_of_whole_records(spark):
    path = work_dir(spark)
    arc.archive_pages(frame(spark, [(1, "a"), (2, "a"), (3, "b")]), path=path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    kinds = [f["warc-type"] for x in files for f, _ in arc.parse_warc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(x.content))))]
    assert sorted(k for k in kinds if k != "warcinfo") == ["response", "response", "revisit"] and "warcinfo" in kinds
