"""WARC derivatives: metadata and plain-text conversion records of HTTP responses.

``responses`` makes response records of crawled pages, ``write_warc`` and ``read_warc``
store records of any kind as WARC 1.1 files with one gzip member a record, and
``derive`` turns each response into two records that refer to it:

* a metadata record (JSON): the response's own WARC headers, HTTP status and headers, the
  payload's length and digest, title, language, description and links with their text; HTTP
  headers are a list in their order, as names may repeat;
* a conversion record (text/plain): the visible text, one block a line, of the payload
  without its transfer and content encodings (chunked, gzip, deflate).

Both have WARC-Refers-To (the response's id), its target URI and date, and
WARC-Refers-To-Target-URI and -Date; the metadata record names the conversion by
WARC-Concurrent-To. Record ids are made from the response's id and the kind, so a task
that runs again makes the same records. Digests are SHA-1 in base 32.

Records are rows: record_id, type, refers_to, uri, date, content_type, headers (a map of
further WARC headers; one that repeats has its values in lines), block (bytes), block_digest, and ``source``, the id of the page a
record comes from, kept as the header X-Source-Id. Files are written per task under a name
of the attempt; the index that is returned names those of successful attempts, with each
record's file, place and length, and ``read_warc`` takes an index. Folders may be in any
store that pyarrow reads and writes.

Null and empty pages have an empty payload and an empty conversion; pages without URL have
no target URI, and line breaks in one are escaped; repeated rows of one page give equal records, one each. Responses whose
block is not HTTP have no status and are taken as payload as a whole. Empty tables give
empty results.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.blocks import cut_blocks
from riverloom.session import map_arrow, new_folder, saved

RECORD = (
    "source long, record_id string, type string, refers_to string, uri string, date string, content_type string, "
    "headers map<string,string>, block binary, block_digest string"
)
INDEX = (
    "source long, record_id string, type string, refers_to string, uri string, block_digest string, "
    "content_length long, file string, place long, length long"
)
_NAMES = [f.split()[0] for f in RECORD.split(", ")]
_KINDS = [pa.int64(), *[pa.string()] * 6, pa.map_(pa.string(), pa.string()), pa.binary(), pa.string()]
_SCHEMA = pa.schema(list(zip(_NAMES, _KINDS)))
_INDEX = pa.schema(
    [("source", pa.int64()), *((n, pa.string()) for n in ("record_id", "type", "refers_to", "uri", "block_digest")),
     ("content_length", pa.int64()), ("file", pa.string()), ("place", pa.int64()), ("length", pa.int64())]
)
DATE = "2024-01-01T00:00:00Z"
#: our columns and the headers of the format
_HEADERS = {
    "record_id": "WARC-Record-ID", "type": "WARC-Type", "refers_to": "WARC-Refers-To", "uri": "WARC-Target-URI",
    "date": "WARC-Date", "content_type": "Content-Type", "block_digest": "WARC-Block-Digest", "source": "X-Source-Id",
}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def made_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(parts))}>"


def _record(**fields) -> dict:
    return {n: None for n in _NAMES} | fields | {"block_digest": digest(fields["block"])}


def _batch(records: list[dict]) -> pa.RecordBatch:
    rows = [r | {"headers": list((r["headers"] or {}).items())} for r in records]
    return pa.RecordBatch.from_pylist(rows, _SCHEMA)


def response(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> dict:
    payload = (html or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record(
        source=page_id, record_id=made_id(str(page_id), url or "", digest(payload)), type="response", uri=url, date=date,
        content_type="application/http; msgtype=response", headers={"WARC-Payload-Digest": digest(payload)},
        block=head.encode() + payload,
    )


def split_http(block: bytes) -> tuple[str | None, list[tuple[str, str]], bytes]:
    """Status line, headers in their order (names may repeat) and payload of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    end = re.search(rb"\r?\n\r?\n", block)
    head, payload = (block[: end.start()], block[end.end() :]) if end else (block, b"")
    lines = re.split(r"\r?\n", head.decode("latin-1"))
    headers = [(a.strip(), b.strip()) for a, _, b in (x.partition(":") for x in lines[1:])]
    return lines[0], headers, payload


def values(headers: list[tuple[str, str]], name: str) -> list[str]:
    """What a header says, over all its lines and commas."""
    return [v.strip() for a, b in headers if a.lower() == name for v in b.split(",") if v.strip()]


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.index(b"\n", at)
        size = int(data[at:end].split(b";")[0].strip(), 16)
        if not size:
            return b"".join(out)
        if end + 1 + size > len(data):
            raise ValueError("a chunk ends early")
        out.append(data[end + 1 : end + 1 + size])
        at = data.index(b"\n", end + 1 + size) + 1


def decoded(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """The payload without transfer and content encodings; as it is where they do not hold."""
    coded = [v.lower() for n in ("content-encoding", "transfer-encoding") for v in values(headers, n)]
    out = payload
    try:
        for name in reversed(coded):
            if name == "chunked":
                out = _unchunked(out)
            elif name in ("gzip", "x-gzip"):
                out = gzip.decompress(out)
            elif name == "deflate":  # with the wrapper of zlib or without
                out = zlib.decompress(out) if out[:1] == b"\x78" else zlib.decompress(out, -15)
            elif name != "identity":
                return payload
    except (ValueError, OSError, EOFError, zlib.error):
        return payload
    return out


_TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title|\Z)", re.IGNORECASE | re.DOTALL)
_LANG = re.compile(r"<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.IGNORECASE)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))[^>]*>(.*?)(?=</a|<a\b|\Z)", re.IGNORECASE | re.DOTALL)
_DESCRIPTION = re.compile(r"<meta\b[^>]*?name\s*=\s*[\"']?description[\"']?[^>]*?content\s*=\s*\"([^\"]*)\"", re.IGNORECASE)


def _plain(markup: str) -> str:
    return " ".join(b.text for b in cut_blocks(markup))


def derive_record(r: dict) -> list[dict]:
    """Metadata and conversion of a response."""
    status, headers, payload = split_http(r["block"])
    charset = re.search(r"charset=\"?([\w-]+)", " ".join(values(headers, "content-type")), re.IGNORECASE)
    plain = decoded(headers, payload)
    try:
        page = plain.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = plain.decode("utf-8", "replace")
    text = "\n".join(b.text for b in cut_blocks(page))
    conversion, metadata = (made_id(r["record_id"], kind) for kind in ("conversion", "metadata"))
    refers = {"WARC-Refers-To-Date": r["date"]}
    if r["uri"] is not None:
        refers["WARC-Refers-To-Target-URI"] = _escaped(r["uri"])
    title, lang, about = _TITLE.search(page), _LANG.search(page), _DESCRIPTION.search(page)
    found = {
        "source-headers": {_HEADERS[k]: r[k] for k in ("record_id", "type", "uri", "date", "content_type", "block_digest") if r[k] is not None}
        | (r["headers"] or {}),
        "http": {"status": status, "headers": [list(h) for h in headers]},
        "payload": {"length": len(payload), "digest": digest(payload)},
        "html": {
            "title": _plain(title[1]) if title else None,
            "lang": lang[1] if lang else None,
            "description": about[1] if about else None,
            "links": [{"url": m[1] or m[2] or m[3] or "", "text": _plain(m[4])} for m in _LINK.finditer(page)],
        },
        "conversion": {"id": conversion, "digest": digest(text.encode())},
    }
    common = {"source": r["source"], "refers_to": r["record_id"], "uri": r["uri"], "date": r["date"]}
    return [
        _record(
            **common, record_id=metadata, type="metadata", content_type="application/json",
            headers=refers | {"WARC-Concurrent-To": conversion},
            block=json.dumps(found, ensure_ascii=False, sort_keys=True).encode(),
        ),
        _record(
            **common, record_id=conversion, type="conversion", content_type="text/plain; charset=utf-8",
            headers=refers | {"WARC-Source-Payload-Digest": digest(payload)}, block=text.encode(),
        ),
    ]


def _escaped(value) -> str:
    """A line break would end the header."""
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def member(r: dict) -> bytes:
    """The record as a gzip member. A header that repeats has its values in lines."""
    lines = ["WARC/1.1"] + [f"{h}: {_escaped(r[c])}" for c, h in _HEADERS.items() if r[c] is not None]
    lines += [f"{k}: {_escaped(v)}" for k, many in (r["headers"] or {}).items() for v in many.split("\n")]
    lines.append(f"Content-Length: {len(r['block'])}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + r["block"] + b"\r\n\r\n", 3, mtime=0)


def parse(raw: bytes) -> dict:
    """The record of a gzip member; raises if its length or digest is wrong."""
    data = gzip.decompress(raw)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    found: dict[str, str] = {}
    for name, _, value in (x.partition(":") for x in lines[1:]):
        found[name] = f"{found[name]}\n{value.strip()}" if name in found else value.strip()
    size = int(found.pop("Content-Length"))
    block = rest[:size]
    out = {c: found.pop(h, None) for c, h in _HEADERS.items()}
    out["source"] = None if out["source"] is None else int(out["source"])
    if len(block) != size or out["block_digest"] not in (None, digest(block)):
        raise ValueError(f"damaged record {out['record_id']}")
    return out | {"headers": found, "block": block}


def _records(batch: pa.RecordBatch):
    for r in batch.to_pylist():
        yield r | {"headers": dict(r["headers"] or [])}


def _respond(batches):
    for batch in batches:
        yield _batch([response(r["page_id"], r["url"], r["html"]) for r in batch.to_pylist()])


def _derive(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            yield _batch([d for r in _records(batch.slice(lo, 500)) for d in derive_record(r)])


def _write(folder: str):
    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():09d}-{uuid.uuid4().hex[:8]}.warc.gz"
        out, place = None, 0
        for batch in batches:
            rows = []
            for r in _records(batch):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                raw = member(r)
                out.write(raw)
                fields = {c: r[c] for c in ("source", "record_id", "type", "refers_to", "uri", "block_digest")}
                rows.append(fields | {"content_length": len(r["block"]), "file": f"{folder}/{name}", "place": place, "length": len(raw)})
                place += len(raw)
            yield pa.RecordBatch.from_pylist(rows, _INDEX)
        if out is not None:
            out.close()

    return run


def _read(batches):
    for batch in batches:
        files: dict = {}
        records, size = [], 0
        for r in batch.to_pylist():
            if r["file"] not in files:
                store, path = fs.FileSystem.from_uri(r["file"])
                files[r["file"]] = store.open_input_file(path)
            f = files[r["file"]]
            f.seek(r["place"])
            records.append(parse(f.read(r["length"])))
            size += len(records[-1]["block"])
            if size > 4 << 20:
                yield _batch(records)
                records, size = [], 0
        yield _batch(records)
        for f in files.values():
            f.close()


def responses(pages: DataFrame) -> DataFrame:
    """Response records of pages (page_id, url, html)."""
    columns = [F.col("page_id").cast("long").alias("page_id"), "url", "html"]
    return map_arrow(pages.select(*columns), _respond, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the responses among records."""
    return map_arrow(records.where("type = 'response'").select(*_NAMES), _derive, RECORD)


def write_warc(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write records to gzipped WARC files; returns their index."""
    folder = folder or new_folder(records.sparkSession, "warc")
    return saved(map_arrow(records.select(*_NAMES), _write(folder), INDEX), "warc-index")


def read_warc(index: DataFrame) -> DataFrame:
    """The records of an index, read from their files and checked."""
    return map_arrow(index.select("file", "place", "length"), _read, RECORD)
