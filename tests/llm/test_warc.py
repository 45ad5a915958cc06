import base64
import gzip
import hashlib
import json
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import pytest

from riverloom.llm import queries, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, block string, type int"
PAGE = '<html lang="fr"><title>A &amp; b</title><body><nav><a href="/x">One <b>two</b></a><a href=\'/y\'>3</a></nav><p>Caf&eacute;</p>'


def plain_digest(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip_and_links(spark):
    rows = [(1, "http://a/1", PAGE, "b", 1), (2, None, None, "b", 1), (None, "http://a/3", "", "b", 1), (1, "http://a/1", PAGE, "b", 1), (5, "u", "x\r\n\r\ny" * 20_000, "b", 1)]
    made = warc.responses(spark.createDataFrame(rows, SCHEMA))
    index = warc.write_warc(made)
    back = warc.read_warc(index)
    key = lambda r: (str(r.source), r.record_id)
    first, second = sorted(made.collect(), key=key), sorted(back.select(*made.columns).collect(), key=key)
    assert first == second and len(first) == 5
    derived = warc.read_warc(warc.write_warc(warc.derive(back))).collect()
    assert len(derived) == 10
    by_id = {r.record_id: r for r in first}
    for d in derived:
        source = by_id[d.refers_to]
        assert d.source == source.source and d.uri == source.uri and d.date == source.date
        assert d.block_digest == plain_digest(d.block)
        assert d.headers.get("WARC-Refers-To-Target-URI") == source.uri
        payload = bytes(source.block).split(b"\r\n\r\n", 1)[1]
        if d.type == "metadata":
            found = json.loads(d.block)
            assert found["payload"] == {"length": len(payload), "digest": plain_digest(payload)}
            assert found["source-headers"]["WARC-Record-ID"] == source.record_id
            assert found["http"]["status"] == "HTTP/1.1 200 OK"
            assert d.headers["WARC-Concurrent-To"] == found["conversion"]["id"]
            other = [c for c in derived if c.record_id == found["conversion"]["id"]]
            assert other and all(c.type == "conversion" and c.block_digest == found["conversion"]["digest"] for c in other)
            if d.source == 1:
                assert found["html"] == {
                    "title": "A & b", "lang": "fr", "description": None,
                    "links": [{"url": "/x", "text": "One two"}, {"url": "/y", "text": "3"}],
                }
        else:
            assert d.headers["WARC-Source-Payload-Digest"] == plain_digest(payload) == source.headers["WARC-Payload-Digest"]
            if d.source == 1:
                assert bytes(d.block).decode() == "One two3\nCafé"


def test_files_are_plain_warc(spark):
    index = warc.write_warc(warc.responses(spark.createDataFrame([(1, "http://a/1", PAGE, "b", 1)], SCHEMA))).collect()
    raw = Path(urlparse(index[0].file).path).read_bytes()
    data = gzip.decompress(raw[index[0].place : index[0].place + index[0].length])
    head, block = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and f"Content-Length: {len(block) - 4}" in lines and block.endswith(b"\r\n\r\n")
    damaged = gzip.compress(data.replace(b"Caf", b"Cof"))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(damaged)


def test_other_blocks_and_empty_tables(spark):
    odd = warc._record(source=1, record_id="r", type="response", uri=None, date="d", content_type="x", headers={}, block=b"<p>no http")
    assert [bytes(d["block"]) for d in warc.derive_record(odd)][1] == b"no http"
    empty = warc.responses(spark.createDataFrame([], SCHEMA))
    assert warc.read_warc(warc.write_warc(warc.derive(empty))).count() == 0


def test_pages(spark):
    rows = duckdb.execute(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    got = queries.QUERIES["op2_warc_derivatives"](spark, SF).collect()
    assert len(got) == 2 * len(rows)
    for page_id, url, page in rows:
        meta, text = sorted((r for r in got if r.page_id == page_id), key=lambda r: r.type, reverse=True)
        assert (meta.type, text.type) == ("metadata", "conversion") and meta.uri == text.uri == url
        assert meta.refers_to == text.refers_to == warc.made_id(str(page_id), url, plain_digest(page.encode()))
        assert text.payload_digest == plain_digest(page.encode()) and meta.concurrent_to == text.record_id
        want = "\n".join(b.text for b in warc.cut_blocks(page)).encode()
        assert (text.block_digest, text.content_length) == (plain_digest(want), len(want))


def test_headers_repeat_and_payloads_are_coded():
    import zlib

    page = b"<html><p>Caf\xe9 one</p>"
    raw = zlib.compressobj(wbits=-15)
    deflated = raw.compress(page) + raw.flush()
    chunked = lambda x: b"5;a=b\r\n" + x[:5] + b"\r\n" + f"{len(x) - 5:X}".encode() + b"\r\n" + x[5:] + b"\r\n0\r\n\r\n"
    cases = [
        ("", page), ("Content-Encoding: gzip", gzip.compress(page)), ("Transfer-Encoding: chunked", chunked(page)),
        ("content-encoding: gzip\r\ntransfer-encoding: Chunked", chunked(gzip.compress(page))),
        ("Content-Encoding: deflate", zlib.compress(page)), ("Content-Encoding: deflate", deflated),
        ("Content-Encoding: gzip", page), ("Transfer-Encoding: chunked", page),
    ]
    for line in ("\r\n", "\n"):
        for head, payload in cases:
            lines = ["HTTP/1.1 200 OK", "Set-Cookie: a=1", "Content-Type: text/html; charset=\"latin-1\"", "Set-Cookie: b=2; x"]
            block = line.join([*lines, *filter(None, head.split("\r\n")), "", ""]).encode() + payload
            source = warc._record(source=1, record_id="<r>", type="response", uri="u\r\nv", date="d", content_type="x", headers={"WARC-Concurrent-To": "<a>\n<b>"}, block=block)
            back = warc.parse(warc.member(source))
            assert back["headers"]["WARC-Concurrent-To"] == "<a>\n<b>" and back["uri"] == "u%0D%0Av"
            meta, text = warc.derive_record(source)
            assert text["block"].decode() == "Café one", head
            found = json.loads(meta["block"])
            assert [h for h in found["http"]["headers"] if h[0] == "Set-Cookie"] == [["Set-Cookie", "a=1"], ["Set-Cookie", "b=2; x"]]
            assert found["payload"] == {"length": len(payload), "digest": plain_digest(payload)}
            assert found["source-headers"]["WARC-Concurrent-To"] == "<a>\n<b>"
            again = warc.parse(warc.member(meta))
            assert again["headers"]["WARC-Refers-To-Target-URI"] == "u%0D%0Av" and again["block"] == meta["block"]


def visible(page):
    """Text of block elements by the standard parser, for pages without odd markup."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.lines, self.parts, self.skip = [], [], 0

        def end(self):
            if text := " ".join("".join(self.parts).split()):
                self.lines.append(text)
            self.parts = []

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style", "title"):
                self.end()
                self.skip += 1
            elif tag == "br":
                self.parts.append(" ")
            elif tag not in ("a", "b", "i", "em", "strong", "span", "code", "input", "img"):
                self.end()

        def handle_endtag(self, tag):
            if tag in ("script", "style", "title"):
                self.skip -= 1
            elif tag not in ("a", "b", "i", "em", "strong", "span", "code"):
                self.end()

        def handle_data(self, data):
            if not self.skip:
                self.parts.append(data)

    reader = Reader()
    reader.feed(page)
    reader.close()
    reader.end()
    return "\n".join(reader.lines)


def test_conversion_against_the_standard_parser():
    rows = duckdb.execute(f"SELECT html FROM '{SF}/pages.parquet'").fetchall()
    whole = [page for (page,) in rows if page.rstrip().endswith("</html>")]
    assert len(whole) > 10
    for page in whole:
        _, text = warc.derive_record(warc.response(1, "u", page))
        assert text["block"].decode() == visible(page)
