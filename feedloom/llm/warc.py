"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

``responses`` wraps stored pages as response records; ``derivatives`` makes, of every response, a metadata
record (``application/warc-fields``: status, title, character set, links) and a conversion record
(``text/plain``).  Both name the response in ``WARC-Refers-To``; the metadata record also in
``WARC-Concurrent-To``.  The response's own WARC fields that describe the capture are copied, its HTTP
headers are kept as metadata fields, and its block and payload digests are carried along.  ``serialise``
gives the bytes of a record.

Defined results: a null page is an empty payload, whose text is empty; a null address leaves the target field
out; repeated rows give repeated records with the same identifiers; broken mark-up is taken as text, and an
open script, style or comment ends with the page; a null ``page_id`` stays null.  Other columns are not read.
Pages are scanned from left to right once per rule, so time follows their length, whatever is left unclosed.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
CAPTURED = "2024-01-01T00:00:00Z"
# Fields that belong to one record alone and are not copied to what is made of it.
OWN = {"WARC-Type", "WARC-Record-ID", "WARC-Block-Digest", "WARC-Payload-Digest", "WARC-Identified-Payload-Type", "Content-Length", "Content-Type"}

_OPEN = re.compile(r"<!--|<(script|style|noscript|template)\b", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "title")}
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-z/!?][^>]*>", re.I)
_SPACE = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b", re.I)
_META = re.compile(r"<meta\b([^>]*)", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.I)
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _visible(page: str) -> str:
    """The page without comments, scripts and the like; one that stays open ends with the page."""
    kept, start, at, last = [], 0, 0, page.rfind(">")
    while found := _OPEN.search(page, at):
        at = found.end()
        if found[1] is None:
            end = page.find("-->", at)
            end = end + 3 if end >= 0 else len(page)
        elif at > last:
            continue  # a tag that nothing closes is text
        else:
            closed = _CLOSE[found[1].lower()].search(page, page.find(">", at) + 1)
            end = closed.end() if closed else len(page)
        kept.append(page[start:found.start()])
        start = at = end
    return "".join(kept) + page[start:]


def _without_tags(text: str, blocks: str = "") -> str:
    """Tags go, those of blocks become ``blocks``; behind the last ``>`` there is no tag."""
    cut = text.rfind(">") + 1
    return _TAG.sub("", _BLOCK.sub(blocks, text[:cut])) + text[cut:]


def _title(page: str) -> str | None:
    """What the first title holds; if that one stays open, so do all others."""
    found = _TITLE.search(page)
    begin = page.find(">", found.end()) + 1 if found else 0
    closed = _CLOSE["title"].search(page, begin) if begin else None
    return page[begin:closed.start()] if closed else None


def _charset(page: str) -> str | None:
    for found in _META.finditer(page):
        if named := _CHARSET.findall(found[1]):
            return named[-1]
    return None


def _links(page: str) -> list[str]:
    """The address of each anchor.  The next end of a tag and the next address are kept while they lie ahead."""
    links, at, end, href = [], 0, -1, None
    while found := _ANCHOR.search(page, at):
        at = found.end()
        if end < at:
            end = page.find(">", at)
            end = len(page) if end < 0 else end
        if href is None or href.start() < at:
            href = _HREF.search(page, at)
            if href is None:
                break
        if href.start() >= end:
            continue
        value = _VALUE.match(page, href.end())
        if value:
            links.append(value[1] or value[2] or value[3] or "")
            at = value.end()
        else:
            at = href.end()
    return links


def plain_text(page: str) -> str:
    """The text a reader sees: a line per block, spaces squeezed, references resolved once."""
    text = _without_tags(_visible(page), "\n")
    return _LINES.sub("\n", _SPACE.sub(" ", html.unescape(text))).strip()


def _one_line(text: str) -> str:
    return " ".join(html.unescape(_without_tags(text)).split())


def responses(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """Stored pages ``(page_id, url, html)`` as response records: identifier, WARC fields, HTTP header, payload."""
    page = F.coalesce("html", F.lit(""))
    key = F.md5(F.concat_ws("\n", F.lit(captured), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), page))
    parts = [F.substring(key, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(page).cast("string"), F.lit("\r\n\r\n"))
    fields = F.map_filter(F.create_map(
        F.lit("WARC-Target-URI"), F.col("url"), F.lit("WARC-Date"), F.lit(captured), F.lit("WARC-Identified-Payload-Type"), F.lit("text/html"),
    ), lambda _, value: value.isNotNull())
    return pages.select(
        F.col("page_id").cast("long"), F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts)).alias("record_id"),
        fields.alias("fields"), http.alias("http"), page.alias("payload"),
    )


_RECORD = pa.schema([
    ("page_id", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
    ("concurrent_to", pa.string()), ("target_uri", pa.string()), ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
    ("block_digest", pa.string()), ("source_block_digest", pa.string()), ("source_payload_digest", pa.string()),
    ("source_http", pa.string()), ("content_length", pa.int64()), ("block", pa.string()),
])
_KINDS = (
    "page_id long, kind string, record_id string, refers_to string, concurrent_to string, target_uri string, "
    "fields array<struct<name:string,value:string>>, block_digest string, source_block_digest string, "
    "source_payload_digest string, source_http string, content_length long, block string"
)


def _metadata(http: str, page: str) -> str:
    status, *headers = http.strip().split("\r\n")
    title, charset = _title(page), _charset(page)
    lines = [("http-status", " ".join(status.split()[1:2]))]
    lines += [(f"http-header-{name.strip().lower()}", value.strip()) for name, _, value in (h.partition(":") for h in headers if h)]
    lines += [("title", _one_line(title))] if title is not None else []
    lines += [("charset", charset.lower())] if charset else []
    lines += [("outlink", f"{_one_line(link)} L a/@href") for link in _links(_visible(page))]
    return "".join(f"{name}: {value}\r\n" for name, value in lines)


def _derived(page_id, source: str, fields: list[tuple[str, str]], http: str, page: str):
    payload, copied = page.encode(), [(k, v) for k, v in sorted(fields) if k not in OWN]
    target = dict(copied).get("WARC-Target-URI")
    whole = digest(http.encode() + payload), digest(payload)
    for kind, content, block in (
        ("metadata", "application/warc-fields", _metadata(http, page)),
        ("conversion", "text/plain; charset=utf-8", plain_text(page)),
    ):
        record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{source}#{kind}").urn
        concurrent = source if kind == "metadata" else None
        size, own = len(block.encode()), digest(block.encode())
        header = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Refers-To", f"<{source}>")]
        header += [("WARC-Concurrent-To", f"<{source}>")] if concurrent else []
        header += [*copied, ("WARC-Block-Digest", own), ("Content-Type", content), ("Content-Length", str(size))]
        names = [{"name": k, "value": v} for k, v in header]
        yield page_id, kind, record_id, source, concurrent, target, names, own, *whole, http, size, block


def derivatives(records: DataFrame) -> DataFrame:
    """Two records per response; ``fields`` are the WARC header in order."""

    def make(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [r for source in zip(*(c.to_pylist() for c in part.columns)) for r in _derived(*source)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    return records.select("page_id", "record_id", "fields", "http", "payload").mapInArrow(make, _KINDS)


def serialise(records: DataFrame) -> Column:
    """The record as it stands in a WARC file."""
    lines = F.array_join(F.transform(records["fields"], lambda f: F.concat(f["name"], F.lit(": "), f["value"], F.lit("\r\n"))), "")
    return F.concat(F.lit(f"{VERSION}\r\n"), lines, F.lit("\r\n"), records["block"], F.lit("\r\n\r\n"))
