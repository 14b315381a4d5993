"""WARC derivatives: metadata and plain-text conversion records of responses.

A record is a row: ``record_id``, ``record_type``, ``headers`` (named fields in
order, as an array of name and value) and ``block`` (bytes). From every response
record come

* a ``metadata`` record: JSON with the source's named fields, HTTP status, HTTP
  headers, the page's title, meta elements and links, and the payload's length and
  digest;
* a ``conversion`` record, if the payload is text: its visible text blocks, one a
  line, as UTF-8.

Both carry ``WARC-Refers-To`` with the source's record id, its target URI and
date, the block digest of their own and the payload digest of the source; record
ids are name-based (SHA-1 of source id and type), so a repeated task writes the
same records. HTTP chunked and gzip/deflate codings are undone. ``member`` gives a
record as a gzip member, which can be written one after another as a WARC file,
and ``parse`` reads such bytes.

Defined results: records that are no responses have no derivatives; a block that is
no HTTP message has a metadata record with NULL status and no conversion record;
missing fields are left out; repeated rows have equal derivatives (there are no ties);
blocks of any length are read whole; empty tables give empty results; other columns are
never read, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.llm.html_extraction import blocks

RECORD = "record_id string, record_type string, headers array<struct<name:string,value:string>>, block binary"
# Fixed values of the format.
VERSION = b"WARC/1.0"
CRLF = b"\r\n"
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|(?P<tag><(?P<kind>script|style)\b[^>]*>).*?(?:</(?P=kind)\s*>|\Z)", re.IGNORECASE | re.DOTALL)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.IGNORECASE | re.DOTALL)
_META = re.compile(r"<meta\b([^>]*)>", re.IGNORECASE)
_LINK = re.compile(r"<(a|link|img|script|iframe|area|form)\b([^>]*)>", re.IGNORECASE)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_TARGET = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}

Fields = list[tuple[str, str]]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(name: str) -> str:
    """A name-based (version 5 layout) UUID as a record id."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name.encode()).digest()[:16], version=5)}>"


def serialize(headers: Fields, block: bytes) -> bytes:
    head = CRLF.join([VERSION, *(f"{n}: {v}".encode() for n, v in headers)])
    return head + CRLF * 2 + block + CRLF * 2


def member(headers: Fields, block: bytes) -> bytes:
    """The record as one gzip member."""
    return gzip.compress(serialize(headers, block), mtime=0)


def parse(data: bytes) -> Iterator[tuple[Fields, bytes]]:
    """The records of WARC bytes, plain or in gzip members."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(CRLF * 2, at)
        fields = _fields(data[at:end].split(CRLF)[1:])
        size = next((int(v) for n, v in fields if n.lower() == "content-length"), 0)
        block = data[end + 4 : end + 4 + size]
        yield fields, block
        at = end + 4 + size


def _fields(lines: list[bytes]) -> Fields:
    out: Fields = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:  # a folded value
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif ":" in text:
            name, value = text.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def _get(fields: Fields, name: str) -> str | None:
    return next((v for n, v in fields if n.lower() == name.lower()), None)


def _codings(fields: Fields, name: str) -> list[str]:
    """The codings that all fields of this name list, in the order they were applied."""
    return [c.strip().lower() for n, v in fields if n.lower() == name.lower() for c in v.split(",") if c.strip()]


def _unchunked(body: bytes) -> bytes:
    out, at = bytearray(), 0
    while (end := body.find(CRLF, at)) >= 0:
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if n == 0:
            break
        out += body[end + 2 : end + 2 + n]
        at = end + 4 + n
    return bytes(out)


def _inflated(body: bytes, gzipped: bool) -> bytes:
    """gzip with all its members; deflate with or without the zlib header. What does not decode stays as it is."""
    out, left = b"", body
    while left:
        for bits in (47,) if gzipped else (15, -15):
            member = zlib.decompressobj(bits)
            try:
                out += member.decompress(left)
                break
            except zlib.error:
                continue
        else:
            return out or body
        left = member.unused_data if gzipped else b""
    return out


def _body(fields: Fields, body: bytes) -> bytes:
    """The payload without transfer and content codings (as far as it decodes), the last applied undone first."""
    for coding in [*reversed(_codings(fields, "Transfer-Encoding")), *reversed(_codings(fields, "Content-Encoding"))]:
        if coding == "chunked":
            body = _unchunked(body)
        elif coding in ("gzip", "x-gzip", "deflate"):
            body = _inflated(body, "gzip" in coding)
    return body


def http_message(block: bytes) -> tuple[str | None, str | None, Fields, bytes]:
    """(status, reason, headers, raw body) of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None, None, [], block
    head, _, body = block.partition(CRLF * 2)
    lines = head.split(CRLF)
    first = lines[0].decode("latin-1").split(" ", 2)
    return (first[1] if len(first) > 1 else None), (first[2] if len(first) > 2 else ""), _fields(lines[1:]), body


def _values(fields: Fields) -> dict[str, str | list[str]]:
    """Fields by name as first written; the values of a repeated name (in any case) are a list."""
    out: dict[str, list[str]] = {}
    names: dict[str, str] = {}
    for name, value in fields:
        out.setdefault(names.setdefault(name.lower(), name), []).append(value)
    return {n: v if len(v) > 1 else v[0] for n, v in out.items()}


def decode_text(content_type: str, body: bytes) -> str:
    """Text in the charset of the header, else of the page, else UTF-8."""
    named = _CHARSET.search(content_type) or _CHARSET.search(body[:2048].decode("latin-1"))
    try:
        return body.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _attributes(raw: str) -> dict[str, str]:
    return {n.lower(): html.unescape(a or b or c) for n, a, b, c in _ATTR.findall(raw)}


def _derived(source: Fields, record_id: str, kind: str, content_type: str, block: bytes, payload: str | None) -> tuple:
    headers: Fields = [("WARC-Type", kind)]
    headers += [(n, v) for n in ("WARC-Target-URI", "WARC-Date", "WARC-Warcinfo-ID") if (v := _get(source, n))]
    own = record_urn(f"{record_id}|{kind}")
    headers += [("WARC-Record-ID", own), ("WARC-Refers-To", record_id), ("WARC-Block-Digest", digest(block))]
    if payload:
        headers.append(("WARC-Payload-Digest", payload))
    headers += [("Content-Type", content_type), ("Content-Length", str(len(block)))]
    return own, kind, headers, block


def derivatives(record_id: str, source: Fields, block: bytes) -> list[tuple]:
    """The metadata and (for text) conversion record of one response."""
    status, reason, http, raw = http_message(block)
    content_type = _get(http, "Content-Type") or ""
    media = content_type.split(";")[0].strip().lower()
    is_text = status is not None and (media.startswith("text/") or media in ("application/xhtml+xml", "application/xml", "application/json"))
    body = _body(http, raw)
    text = decode_text(content_type, body) if is_text else ""
    payload = _get(source, "WARC-Payload-Digest") or digest(raw)
    page: dict = {}
    if is_text and ("html" in media):
        # Comments, scripts and styles hold no links of the page; their own tags may.
        markup = _HIDDEN.sub(lambda m: m["tag"] or " ", text)
        title = _TITLE.search(markup)
        page = {
            "Title": " ".join(html.unescape(title[1]).split()) if title else None,
            "Metas": [_attributes(m) for m in _META.findall(markup)],
            "Links": [
                {"path": f"{tag.lower()}@{_TARGET[tag.lower()]}", "url": url}
                for tag, raw_attrs in _LINK.findall(markup) if (url := _attributes(raw_attrs).get(_TARGET[tag.lower()]))
            ],
        }
    meta = {
        "Envelope": {
            "WARC-Header-Metadata": _values(source),
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {"Status": status, "Reason": reason, "Headers": _values(http), "HTML-Metadata": page},
                "Entity-Length": len(raw), "Entity-Digest": payload,
            },
            "Block-Digest": digest(block),
        }
    }
    data = json.dumps(meta, ensure_ascii=False, separators=(",", ":")).encode()
    out = [_derived(source, record_id, "metadata", "application/json", data, payload)]
    if is_text:
        plain = "\n".join(b.text for b in blocks(text)) if "html" in media else text
        out.append(_derived(source, record_id, "conversion", "text/plain", plain.encode(), payload))
    return out


def responses(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Response records of pages (a NULL page has an empty payload)."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, url, page in zip(frame["id"], frame["url"], frame["html"]):
                body = (page or "").encode("utf-8", "surrogatepass")
                block = CRLF.join([
                    b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(body), b"", body
                ])
                urn = record_urn(f"{key}|{url}")
                headers = [("WARC-Type", "response"), *([("WARC-Target-URI", url)] if url else []), ("WARC-Date", date)]
                headers += [
                    ("WARC-Record-ID", urn), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)),
                    ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
                ]
                rows.append((urn, "response", [{"name": n, "value": v} for n, v in headers], block))
            yield pd.DataFrame(rows, columns=["record_id", "record_type", "headers", "block"])

    return pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    ).mapInPandas(build, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """The derivative records of all response records."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, headers, block in zip(frame["record_id"], frame["headers"], frame["block"]):
                source = [(h["name"], h["value"]) for h in headers]
                for own, kind, fields, data in derivatives(key, source, bytes(block)):
                    rows.append((own, kind, [{"name": n, "value": v} for n, v in fields], data))
            yield pd.DataFrame(rows, columns=["record_id", "record_type", "headers", "block"])

    usable = records.where(
        (F.col("record_type") == "response") & F.col("record_id").isNotNull() & F.col("headers").isNotNull() & F.col("block").isNotNull()
    )
    return usable.select("record_id", "record_type", "headers", "block").mapInPandas(build, RECORD)


def header(name: str) -> F.Column:
    """The value of a record's named field (NULL without it)."""
    return F.try_element_at(F.filter("headers", lambda h: F.lower(h["name"]) == name.lower()), F.lit(1))["value"]


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    records = derive(responses(read_table(spark, sf_dir, "pages")))
    return records.select(
        "record_id", "record_type", header("WARC-Refers-To").alias("refers_to"), header("WARC-Target-URI").alias("target_uri"),
        header("WARC-Date").alias("warc_date"), header("WARC-Block-Digest").alias("block_digest"),
        header("WARC-Payload-Digest").alias("payload_digest"), header("Content-Length").cast("long").alias("content_length"),
        F.col("block").cast("string").alias("block"),
    )
