"""WARC derivative builder: metadata and plain-text conversion records from responses.

Every response record gives two records that refer to it by its WARC-Record-ID. The
conversion holds the plain text of the payload. The metadata record (warc-fields) names
the conversion and preserves the source's status line, HTTP headers, date and digests,
and tells whether the payload still has the digest it came with. Ids are derived from the
source's id, so a rerun or a repeated task gives the same records.

The digest is that of the payload as it is stored. For the text, chunks are put together
and gzip and deflate undone first; of a damaged body what comes before the fault counts.

Defined cases: null html is an empty payload, a null URL leaves the target URI out. Rows
that repeat give records that repeat. A record that is null or no response gives nothing,
nor does a damaged one: without a WARC header, or with a length that is no number. The
function `damaged` lists those. A response without HTTP headers counts as bare payload. A
payload that is no text (by its type, compared without case, or in another encoding) gives
the metadata record alone. Bytes that the declared charset can't decode are replaced, and
a charset that isn't known counts as UTF-8. Line breaks inside a URL are percent-encoded.
Text of any markup takes time in proportion to its length.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

VERSION = "WARC/1.1"
HIDDEN = re.compile(
    r"<!--|<(/?head|body|title|script|style|noscript|template)(?=[\s/>])[^>]*>", re.IGNORECASE
)
ENDS = {"": re.compile("-->")} | {
    name: re.compile(rf"</{name}\s*>", re.IGNORECASE)
    for name in ("title", "script", "style", "noscript", "template")
}
HEAD_END = re.compile(r"<(?:/head|body)(?=[\s/>])", re.IGNORECASE)
BREAKS = re.compile(
    r"<(?:/?(?:p|div|h[1-6]|li|ul|ol|table|tr|section|article|header|footer|nav|aside|main|"
    r"blockquote|pre|form|figure|dl|dt|dd|body|html)|br|hr)\b[^>]*>",
    re.IGNORECASE,
)
TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
TITLE = re.compile(r"<title\b[^>]*>", re.IGNORECASE)
TEXT_TYPE = re.compile(r"text/.*|application/([\w.-]+\+)?(xml|json)|application/javascript")
CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.IGNORECASE)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    lines += [f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join([VERSION, *lines, "", ""]).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    """First line and fields of a header; folded lines go on the field before."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and fields:
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            fields.append((name.strip(), value.strip()))
    return first, fields


class DamagedRecord(ValueError):
    """Bytes that can't be read as a WARC record."""


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, fields = _fields(head)
    if not first.startswith("WARC/"):
        raise DamagedRecord(f"not a WARC record: {first[:40]!r}")
    named = {name.lower(): value for name, value in fields}
    length = named.get("content-length", str(len(rest)))
    if not (length.isascii() and length.isdigit()):
        raise DamagedRecord(f"not a length: {length[:40]!r}")
    return named, rest[: int(length[:18])]


def _dechunked(body: bytes) -> bytes:
    """The chunks of a chunked body; what follows a damaged chunk is left out."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size) or not int(size, 16):
            return b"".join(parts)
        start, length = end + 2, int(size, 16)
        parts.append(body[start : start + length])
        at = start + length + 2


def _inflated(body: bytes, kind: str) -> bytes:
    """A gzip or deflate body, as far as it can be read."""
    out = []
    while body:
        tries = (31,) if kind == "gzip" else (15, -15)  # deflate comes with and without a head
        for bits in tries:
            reader = zlib.decompressobj(bits)
            try:
                out.append(reader.decompress(body))
                break
            except zlib.error:
                reader = None
        if reader is None:  # damaged: bytes one by one, to the fault
            reader = zlib.decompressobj(tries[0])
            try:
                for k in range(len(body)):
                    out.append(reader.decompress(body[k : k + 1]))
            except zlib.error:
                pass
            break
        body = reader.unused_data if reader.eof and kind == "gzip" else b""
    return b"".join(out)


def decoded(payload: bytes, fields: list[tuple[str, str]]) -> bytes | None:
    """The body without its transfer and content encodings; None if one isn't known."""

    def codings(name: str) -> list[str]:
        values = [v for k, v in fields if k.lower() == name]
        return [c.strip().lower() for c in ",".join(values).split(",") if c.strip()]

    # undone in the reverse order of their application
    for coding in reversed([*codings("content-encoding"), *codings("transfer-encoding")]):
        if coding == "chunked":
            payload = _dechunked(payload)
        elif coding in ("gzip", "x-gzip", "deflate"):
            payload = _inflated(payload, coding.removeprefix("x-"))
        elif coding != "identity":
            return None
    return payload


def _text(payload: bytes, kind: str) -> str:
    charset = CHARSET.search(kind)
    try:
        return payload.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, ValueError):  # no such charset, or one that isn't for text
        return payload.decode("utf-8", "replace")


def _title(markup: str) -> str:
    begin = TITLE.search(markup, 0, markup.rfind(">") + 1)
    end = ENDS["title"].search(markup, begin.end()) if begin else None
    return " ".join(html.unescape(markup[begin.end() : end.start()]).split()) if end else ""


def _shown(markup: str) -> str:
    """`markup` without comments, scripts, styles, noscripts, templates and the head's title.

    Comments, scripts and styles that are never closed reach to the end of the page. Of
    other elements only closed ones are left out, and a head needs no end tag: its title
    is the only text it can hold.
    """
    parts: list[str] = []
    kept = look = 0
    in_head, unclosed = False, set()
    tags_end = markup.rfind(">") + 1  # no tag ends behind it, so none is looked for
    while found := HIDDEN.search(markup, look, tags_end):
        look = found.end()
        name = (found[1] or "").lower()
        if name in ("head", "/head", "body"):
            in_head = name == "head"
            continue
        if name in unclosed or (name == "title" and not in_head):
            continue
        end = ENDS[name].search(markup, look)
        if name == "title" and end and HEAD_END.search(markup, look, end.start()):
            end = None
        if end is None and name in ("title", "noscript", "template"):
            unclosed.add(name)
            continue
        parts.append(markup[kept : found.start()])
        kept = look = end.end() if end else len(markup)
    comment = markup.find("<!--", max(look, tags_end))  # never closed
    return " ".join([*parts, markup[kept : comment if comment >= 0 else len(markup)]])


def plain_text(markup: str) -> str:
    """Visible text, one line per block."""
    text = _shown(markup)
    cut = text.rfind(">") + 1
    text = TAG.sub("", BREAKS.sub("\n", text[:cut])) + text[cut:]
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def response(page_id, url: str | None, markup: str | None, date: str) -> bytes:
    payload = (markup or "").encode()
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", str(page_id), str(target), digest(payload))),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest(payload)),
    ]
    return record(headers, http + payload)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """page_id and `record`, a WARC response record, of every row (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = zip(*(c.to_pylist() for c in part.columns), strict=True)
                made = pa.array([response(*row, date) for row in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), made], ["page_id", "record"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, record binary")


def derived(data: bytes) -> list[dict]:
    """The metadata and (for text) the conversion record of a response record."""
    head, block = parse(data)
    if head.get("warc-type") != "response":
        return []
    source, target, date = (head.get(k) for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    http, cut, payload = block.partition(b"\r\n\r\n")
    if cut and http.startswith(b"HTTP/"):
        status, fields = _fields(http)
    else:
        status, fields, payload = "", [], block
    kind = next((value for name, value in fields if name.lower() == "content-type"), "")
    media = kind.partition(";")[0].strip().lower()
    body = decoded(payload, fields)
    readable = body is not None and (not media or bool(TEXT_TYPE.fullmatch(media)))
    markup = _text(body, kind) if readable else ""
    is_html = "html" in media or not media
    text = plain_text(markup) if is_html else " ".join(markup.split())
    found = digest(payload)
    stated = head.get("warc-payload-digest")
    ids = {what: record_id(what, source or "") for what in ("metadata", "conversion")}
    lines = [
        *([("derivedConversion", ids["conversion"])] if readable else []),
        ("sourceStatus", status),
        *[("sourceHeader", f"{name}: {value}") for name, value in fields],
        ("sourceBlockDigest", head.get("warc-block-digest", digest(block))),
        ("sourcePayloadDigest", stated or found),
        ("payloadDigestMatches", str(stated in (None, found, digest(body or b""))).lower()),
        ("title", _title(markup) if is_html else ""),
    ]
    blocks = {"metadata": "".join(f"{name}: {value}\r\n" for name, value in lines).encode()}
    if readable:
        blocks["conversion"] = text.encode("utf-8", "replace")
    types = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
    out = []
    for what, block in blocks.items():
        headers = [
            ("WARC-Type", what),
            ("WARC-Record-ID", ids[what]),
            ("WARC-Refers-To", source),
            ("WARC-Refers-To-Target-URI", target),
            ("WARC-Refers-To-Date", date),
            ("WARC-Date", date),
            ("WARC-Target-URI", target),
            ("WARC-Concurrent-To", ids["conversion"] if what == "metadata" and readable else None),
            ("Content-Type", types[what]),
        ]
        out.append(
            {
                "warc_type": what,
                "record_id": ids[what],
                "refers_to": source,
                "target_uri": target,
                "n_bytes": len(block),
                "block_digest": digest(block),
                "source_payload_digest": stated or found,
                "record": record(headers, block),
            }
        )
    return out


def _derived_or_nothing(data: bytes | None) -> list[dict]:
    try:
        return derived(data) if data is not None else []
    except DamagedRecord:
        return []


_FIELDS = {
    "warc_type": pa.string(),
    "record_id": pa.string(),
    "refers_to": pa.string(),
    "target_uri": pa.string(),
    "n_bytes": pa.int64(),
    "block_digest": pa.string(),
    "source_payload_digest": pa.string(),
    "record": pa.binary(),
}


def derivatives(records: DataFrame) -> DataFrame:
    """A row per record derived from the responses of `records` (page_id, record): the
    metadata and, of text, the conversion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, rows = [], []
                for k, data in enumerate(part.column(1).to_pylist()):
                    made = _derived_or_nothing(data)
                    rows += made
                    ids += [k] * len(made)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(ids, pa.int64())),
                        *[pa.array([r[c] for r in rows], kind) for c, kind in _FIELDS.items()],
                    ],
                    ["page_id", *_FIELDS],
                )

    kind = records.schema["page_id"].dataType.simpleString()
    schema = (
        f"page_id {kind}, warc_type string, record_id string, refers_to string, "
        "target_uri string, n_bytes long, block_digest string, source_payload_digest string, "
        "record binary"
    )
    return records.select("page_id", "record").mapInArrow(run, schema)


def damaged(records: DataFrame) -> DataFrame:
    """page_id and `problem` of the rows of `records` that can't be read as records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, problems = [], []
            for k, data in enumerate(batch.column(1)):
                try:
                    if data.is_valid:
                        parse(data.as_py())
                except DamagedRecord as error:
                    ids.append(k)
                    problems.append(str(error))
            columns = [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "problem"])

    kind = records.schema["page_id"].dataType.simpleString()
    return records.select("page_id", "record").mapInArrow(run, f"page_id {kind}, problem string")
