import base64
import gzip
import hashlib
import time
import zlib

import pytest

from feira.llm import warc

PAGE = """<html><head><title>A &amp; b</title><style>p{}</style></head><body><h1>Head</h1>
<p>One <b>two</b> &eacute;<br>three<script>no()</script><ul><li>four</ul><!-- no --></body></html>"""
TEXT = "Head\nOne two é\nthree\nfour"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_link_to_their_source():
    source = warc.response(5, "http://a.b/c", PAGE, "2024-05-06T07:08:09Z")
    head, block = warc.parse(source)
    payload = block.partition(b"\r\n\r\n")[2]
    assert payload == PAGE.encode() and head["warc-payload-digest"] == sha1(payload)
    meta, conversion = warc.derived(source)
    for made in (meta, conversion):
        fields, body = warc.parse(made["record"])
        assert fields["warc-type"] == made["warc_type"]
        assert fields["warc-record-id"] == made["record_id"] != head["warc-record-id"]
        assert fields["warc-refers-to"] == made["refers_to"] == head["warc-record-id"]
        assert fields["warc-refers-to-target-uri"] == "http://a.b/c"
        assert fields["warc-refers-to-date"] == "2024-05-06T07:08:09Z"
        assert int(fields["content-length"]) == len(body) == made["n_bytes"]
        assert fields["warc-block-digest"] == sha1(body) == made["block_digest"]
        assert made["record"].endswith(body + b"\r\n\r\n")
    assert warc.parse(conversion["record"])[1].decode() == TEXT
    lines = warc.parse(meta["record"])[1].decode().split("\r\n")
    assert f"derivedConversion: {conversion['record_id']}" in lines
    assert "sourceStatus: HTTP/1.1 200 OK" in lines
    assert "sourceHeader: Content-Type: text/html; charset=utf-8" in lines
    assert f"sourcePayloadDigest: {sha1(payload)}" in lines
    assert f"sourceBlockDigest: {head['warc-block-digest']}" in lines
    assert "payloadDigestMatches: true" in lines and "title: A & b" in lines


def made_by_hand(http, payload, digest=None, kind="response"):
    block = http + payload
    headers = [("WARC-Type", kind), ("WARC-Record-ID", "<urn:x>"), ("WARC-Payload-Digest", digest)]
    return warc.record(headers, block)


def test_foreign_records():
    http = b"HTTP/1.0 404 Gone\r\nServer: x\r\n folded\r\nContent-Type: text/html; charset=latin-1\r\n\r\n"
    meta, text = warc.derived(made_by_hand(http, "<p>\xe9".encode("latin-1"), "sha1:WRONG"))
    assert warc.parse(text["record"])[1].decode() == "é"
    body = warc.parse(meta["record"])[1].decode()
    assert "sourceHeader: Server: x folded\r\n" in body
    assert "sourcePayloadDigest: sha1:WRONG\r\npayloadDigestMatches: false" in body
    assert warc.derived(made_by_hand(http, b"x", kind="request")) == []
    bare = warc.derived(made_by_hand(b"", b"<p>bare \xff"))[1]
    assert warc.parse(bare["record"])[1].decode() == "bare \ufffd"
    odd = http.replace(b"latin-1", b"no-such-charset")
    assert warc.parse(warc.derived(made_by_hand(odd, b"ok"))[1]["record"])[1] == b"ok"


def test_plain_text_of_broken_markup():
    assert warc.plain_text("a < b <p>c<!-- open") == "a < b\nc"
    assert warc.plain_text("<script>x") == ""
    start = time.perf_counter()
    warc.plain_text("<script>" * 20_000 + "<!--" * 20_000)
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize(
    "markup, text",
    [
        ("<html><head><title>t</title><body><p>whole article</p></body></html>", "whole article"),
        ("<head><title>t</title><script>'<p>'</script><meta name=a><p>one<p>two", "one\ntwo"),
        ("<head><title>t</title>no <b>blocks</b> at all", "no blocks at all"),
        ("<head><title>open<body><p>one</p><svg><title>s</title></svg>", "open\none\ns"),
        ("<body><noscript>a<p>b</p><template>c<p>d", "a\nb\nc\nd"),
        ("<body><noscript>a</noscript>b<template>c</template>d<noscript> e", "b d e"),
        ("<body>a<style>b<p>c", "a"),
    ],
)
def test_elements_without_end_tag(markup, text):
    assert warc.plain_text(markup) == text


def test_unclosed_noscripts_take_linear_time():
    start = time.perf_counter()
    warc.plain_text("<head>" + "<noscript><template><title>" * 20_000)
    assert time.perf_counter() - start < 5


def test_rows_in_spark(spark):
    rows = [(1, "http://u\r\nX: y", PAGE, "a")] * 2
    rows += [(2, None, None, "b"), (None, "u", "", "c"), (3, "v", "w " * 200_000, "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    found = warc.derivatives(warc.responses(pages)).collect()
    assert len(found) == 2 * len(rows)
    assert len({r.record_id for r in found}) == 2 * (len(rows) - 1)
    by = {(r.page_id, r.warc_type): r for r in found}
    assert by[1, "conversion"].target_uri == "http://u%0D%0AX: y"
    assert warc.parse(by[1, "conversion"].record)[1].decode() == TEXT
    assert by[2, "conversion"].target_uri is None and by[2, "conversion"].n_bytes == 0
    assert by[3, "conversion"].n_bytes == 399_999
    assert warc.derivatives(warc.responses(pages.where("false"))).collect() == []
    records = spark.createDataFrame([(1, None)], "page_id long, record binary")
    assert warc.derivatives(records).collect() == []


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: %s\r\n%s\r\n"


def conversion(payload, kind=b"text/html", more=b""):
    made = warc.derived(made_by_hand(HTTP % (kind, more), payload))
    texts = [warc.parse(m["record"])[1].decode() for m in made if m["warc_type"] == "conversion"]
    return texts[0] if texts else None


def chunks(data, size=3):
    parts = [data[k : k + size] for k in range(0, len(data), size)]
    return b"".join(b"%x;x=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def test_bodies_as_crawlers_store_them():
    page = "<p>h\u00e9llo</p><p>w</p>".encode()
    raw = zlib.compressobj(wbits=-15)
    bare = raw.compress(page) + raw.flush()
    assert conversion(chunks(page), more=b"Transfer-Encoding: chunked\r\n") == "h\u00e9llo\nw"
    for body, coding in ((gzip.compress(page), b"gzip"), (zlib.compress(page), b"Deflate"), (bare, b"deflate"),
                         (gzip.compress(page[:9]) + gzip.compress(page[9:]), b"x-gzip")):
        assert conversion(body, more=b"Content-Encoding: %s\r\n" % coding) == "h\u00e9llo\nw"
        both = b"Content-Encoding: %s\r\nTransfer-Encoding: chunked\r\n" % coding
        assert conversion(chunks(body), more=both) == "h\u00e9llo\nw"
    assert conversion(b"x", more=b"Content-Encoding: br\r\n") is None
    long = b"<p>" + b"word " * 5000
    assert 0 < len(conversion(gzip.compress(long)[:60], more=b"Content-Encoding: gzip\r\n")) < 25_000
    assert conversion(b"no gzip", more=b"Content-Encoding: gzip\r\n") == ""
    assert conversion(b"3\r\nabc\r\nzz\r\nrest", more=b"Transfer-Encoding: chunked\r\n") == "abc"


def test_digest_of_stored_bytes_or_of_the_body():
    page = b"<p>x</p>"
    stored = chunks(page)
    head = HTTP % (b"text/html", b"Transfer-Encoding: chunked\r\n")
    for stated, matches in ((sha1(stored), "true"), (sha1(page), "true"), (sha1(b"y"), "false")):
        meta = warc.derived(made_by_hand(head, stored, stated))[0]
        assert f"payloadDigestMatches: {matches}" in warc.parse(meta["record"])[1].decode()
        assert meta["source_payload_digest"] == stated
    assert warc.derived(made_by_hand(head, stored))[0]["source_payload_digest"] == sha1(stored)


@pytest.mark.parametrize(
    "kind, payload, text",
    [
        (b"TEXT/HTML", b"<p>a<p>b", "a\nb"),
        (b"Application/XHTML+xml; charset=utf-8", b"<p>a<p>b", "a\nb"),
        (b"text/plain", b"a <p> b", "a <p> b"),
        (b"application/ld+json", b'{"a": 1}', '{"a": 1}'),
        (b"image/png", b"\x89PNG", None),
        (b"application/octet-stream", b"abc", None),
        (b"text/html; charset=idna", b"<p>a", "a"),
        (b"text/html; charset=hex", b"<p>a", "a"),
        (b"text/html; charset=utf-16", b"<", "\ufffd"),
        (b"", b"<p>a<p>b", "a\nb"),
    ],
)
def test_types_and_charsets(kind, payload, text):
    assert conversion(payload, kind) == text
    assert warc.derived(made_by_hand(HTTP % (kind, b""), payload))[0]["warc_type"] == "metadata"


def test_damaged_records_are_listed(spark):
    good = warc.response(1, "u", "<p>x", "d")
    bad = [b"", b"no record", b"\xff\x00", good.replace(b"Content-Length: ", b"Content-Length: x", 1)]
    bad.append(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: \xc2\xb2\r\n\r\nabc")
    rows = [(k, r) for k, r in enumerate([good, None, *bad])]
    rows.append((9, b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9999999999999999999999\r\n\r\n<p>y"))
    records = spark.createDataFrame(rows, "page_id long, record binary")
    assert {r.page_id for r in warc.derivatives(records).collect()} == {0, 9}
    assert {r.page_id for r in warc.damaged(records).collect()} == {2, 3, 4, 5, 6}


@pytest.mark.parametrize("piece", ["<p ", "<title>", "<title ", "<!--", "<", "</script", "<script ", "<a href='<'", "&#"])
def test_any_markup_takes_linear_time(piece):
    start = time.perf_counter()
    warc.derived(made_by_hand(HTTP % (b"text/html", b""), (piece * (1_000_000 // len(piece))).encode()))
    assert time.perf_counter() - start < 5


def test_text_behind_the_last_tag():
    assert warc.plain_text("<p>a</p> b < c <p d") == "a\nb < c <p d"
    assert warc.plain_text("<p>a</p> b <!-- c <p d") == "a\nb"
