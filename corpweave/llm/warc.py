"""Derivatives of WARC response records: linked metadata records and plain-text conversions.

A response record is parsed from its bytes. Of every HTTP response that holds HTML or plain text two
records are built: ``metadata`` lists the source's status, headers, title, digests and links, and
``conversion`` holds its text. Both refer to the source by its record id, keep its target URI and
date, and carry digests of their own; the conversion names the metadata record as concurrent. Ids
are derived from the source id and the content, so building again gives the same records.

Chunks and the content encodings gzip and deflate are undone before the text is taken. The payload
digest is that of the body without chunks but as encoded; a stated digest of the body as it stands
counts as verified, too.

Pages are read once from front to back, however many of their tags, quotes and comments stay open. An
encoded body may hold ``MOST_BYTES`` at most, which bounds what a small record can unpack to.

A record that is null, broken, of another encoding, larger than that or no response with a readable body
gives no derivatives but one row with ``problem`` set, so nothing is lost in silence. An empty body gives an empty conversion. Repeated
records give repeated derivatives; other columns than the id and the record are ignored.
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
from pyspark.sql import functions as F

from corpweave.llm.arrow import giving_back, in_small_batches

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
FIELDS = ("record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type",
          "content_length", "block_digest", "source_payload_digest", "content", "warc", "problem")

#: Bytes that an encoded body may hold.
MOST_BYTES = 1 << 26

_HIDDEN = re.compile(r"<(?:(script|style|noscript|template|title)\b|!--)", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "title")}
_ENDS[""] = re.compile("-->")
_BLOCK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|td|th|table|h[1-6]|article|section|header|footer|nav|aside"
    r"|blockquote|pre|form|figure|main|body|html|head)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_ANCHOR = re.compile(r"<a\s", re.I)
_HREF = re.compile(r"href\s*=\s*(?=[^\s>])", re.I)
_UNQUOTED = re.compile(r"[^\s>]+")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.I)


class Broken(ValueError):
    """A record that cannot be read."""


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    """A record id that depends on its parts alone."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {one_line(v)}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def one_line(text: str) -> str:
    return " ".join(text.split()) if "\n" in text or "\r" in text else text


def header_lines(data: bytes) -> list[tuple[str, str]]:
    """Names and values in order; a line that starts with white space goes on with the one before."""
    found: list[tuple[str, str]] = []
    for line in data.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            found.append((name.strip(), value.strip()))
        elif line:
            raise Broken(f"no header line: {line[:40]}")
    return found


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-cased name, block) of one record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise Broken("no WARC header")
    headers = {k.lower(): v for k, v in header_lines(lines)}
    length = headers.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        raise Broken("wrong Content-Length")
    return headers, rest[:int(length)]


def values(http: list[tuple[str, str]], name: str) -> list[str]:
    """The lower-cased items of all headers of a name, in order."""
    items = (x.strip().lower() for k, v in http if k.lower() == name for x in v.split(","))
    return [x for x in items if x and x != "identity"]


def without_chunks(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            raise Broken("broken chunks")
        at, n = end + 2, int(size, 16)
        if n == 0:
            return b"".join(parts)
        if body[at + n:at + n + 2] != b"\r\n":
            raise Broken("broken chunks")
        parts.append(body[at:at + n])
        at += n + 2


def inflated(body: bytes, kind: int) -> bytes:
    """What gzip (31), zlib (15) or raw deflate (-15) holds, all members of it."""
    parts, left = [], MOST_BYTES
    while body:
        member = zlib.decompressobj(kind)
        parts.append(member.decompress(body, left + 1))
        left -= len(parts[-1])
        if left < 0:
            raise Broken("encoded body too large")
        if not member.eof:
            raise Broken("encoded body cut short")
        # After the last gzip member other bytes may follow.
        body = member.unused_data if kind == 31 and member.unused_data[:2] == b"\x1f\x8b" else b""
    return b"".join(parts)


def decoded(body: bytes, encoding: str) -> bytes:
    if encoding not in ("gzip", "x-gzip", "deflate"):
        raise Broken(f"unknown encoding {encoding}")
    try:
        if encoding != "deflate":
            return inflated(body, 31)
        try:
            return inflated(body, 15)
        except zlib.error:
            return inflated(body, -15)
    except zlib.error:
        raise Broken(f"body is not {encoding}") from None


def without_hidden(page: str) -> str:
    """The page without comments and elements that are not shown. One that never ends is kept."""
    parts, start, at, endless = [], 0, 0, set()
    while opened := _HIDDEN.search(page, at):
        at, name = opened.end(), (opened[1] or "").lower()
        if name in endless:
            continue
        if end := _ENDS[name].search(page, at):
            parts.append(page[start:opened.start()])
            start = at = end.end()
        else:
            endless.add(name)
    return "".join(parts) + page[start:]


def replaced(tag: re.Pattern, by: str, page: str) -> str:
    """The page with other text for its tags. Behind the last ``>`` no tag ends, so none is looked for."""
    end = page.rfind(">") + 1
    return tag.sub(by, page[:end]) + page[end:]


def title_of(page: str) -> str | None:
    if opened := _TITLE.search(page, 0, page.rfind(">") + 1):
        if end := _ENDS["title"].search(page, opened.end()):
            return page[opened.end():end.start()]
    return None


def links(page: str) -> Iterator[str]:
    """The first link of every anchor tag."""
    at, last, unpaired = 0, len(page), set()
    while anchor := _ANCHOR.search(page, at):
        end = page.find(">", anchor.end()) if last else -1
        if end < 0:
            end, last = len(page), 0  # nor has any later tag an end
        found = _HREF.search(page, anchor.end(), end)
        if not found:
            at = end
            continue
        at, quote = found.end(), page[found.end()]
        if quote in "\"'" and quote not in unpaired:
            other = page.find(quote, at + 1)
            if other >= 0:
                yield page[at + 1:other]
                at = other + 1
                continue
            unpaired.add(quote)
        value = _UNQUOTED.match(page, at)
        yield value[0]
        at = value.end()


def plain_text(page: str) -> str:
    """Text of a page, a line per block element, without hidden parts."""
    page = replaced(_TAG, "", replaced(_BLOCK, "\n", without_hidden(page)))
    if "&" in page:
        page = html.unescape(page)
    lines = (" ".join(line.split()) for line in page.split("\n"))
    return "\n".join(line for line in lines if line)


def responses(pages: DataFrame, date: str = DATE, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(page_id, warc): every page as a response record."""

    @F.arrow_udf("binary")
    def build(ids: pa.Array, urls: pa.Array, bodies: pa.Array) -> pa.Array:
        found = []
        for key, url, body in zip(ids.to_pylist(), urls.to_pylist(), bodies.to_pylist()):
            payload = (body or "").encode()
            block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                     + str(len(payload)).encode() + b"\r\n\r\n" + payload)
            own = digest(payload)
            found.append(record([
                ("WARC-Type", "response"), ("WARC-Record-ID", urn("response", str(key), url or "", own)),
                ("WARC-Date", date), ("WARC-Target-URI", url or ""), ("WARC-Payload-Digest", own),
                ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"),
            ], block))
        return pa.array(found, pa.binary())

    return pages.select(F.col(id_col).alias("page_id"),
                        build(F.col(id_col).cast("string"), url_col, html_col).alias("warc"))


def derive(data: bytes | None) -> list[dict]:
    """The derivative records of one response record, or one row that says why there are none."""
    try:
        if data is None:
            raise Broken("no record")
        headers, block = parse(data)
        if headers.get("warc-type") != "response":
            raise Broken("not a response")
        source = headers.get("warc-record-id")
        if not source:
            raise Broken("no record id")
        head, gap, payload = block.partition(b"\r\n\r\n")
        status, _, lines = head.partition(b"\r\n")
        if not gap or not status.startswith(b"HTTP/"):
            raise Broken("no HTTP header")
        http = header_lines(lines)
        kind = next((v for k, v in http if k.lower() == "content-type"), "")
        if kind.split(";")[0].strip().lower() not in ("text/html", "application/xhtml+xml", "text/plain"):
            raise Broken("no text")
        body = payload
        for encoding in reversed(values(http, "transfer-encoding") if payload else []):
            payload = without_chunks(payload) if encoding == "chunked" else decoded(payload, encoding)
        entity = payload
        for encoding in reversed(values(http, "content-encoding")):
            if entity or encoding not in ("gzip", "x-gzip", "deflate"):
                entity = decoded(entity, encoding)
        charset = (m := _CHARSET.search(kind)) and m[1] or "utf-8"
        try:
            page = entity.decode(charset, "replace")
        except LookupError:
            page = entity.decode("utf-8", "replace")
    except Broken as problem:
        return [dict.fromkeys(FIELDS) | {"problem": str(problem)}]
    is_html = not kind.lower().startswith("text/plain")
    uri, date = headers.get("warc-target-uri", ""), headers.get("warc-date", "")
    own, said = digest(payload), headers.get("warc-payload-digest")
    text = (plain_text(page) if is_html else page).encode()
    fields = [("source-status", status.decode("latin-1")), *((f"source-header-{k}", v) for k, v in http),
              ("source-payload-digest", said or own),
              ("source-payload-digest-verified", str(said in (None, own, digest(body))).lower()),
              ("source-block-digest", headers.get("warc-block-digest", "")),
              ("source-charset", charset.lower())]
    if is_html:
        if (title := title_of(page)) is not None:
            fields.append(("title", one_line(html.unescape(title).strip())))
        fields += [("outlink", one_line(html.unescape(link))) for link in links(page)]
    about = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    about_digest, text_digest = digest(about), digest(text)
    meta_id, text_id = urn("metadata", source, about_digest), urn("conversion", source, text_digest)

    def made(kind: str, own_id: str, beside: str | None, content_type: str, content: bytes, mark: str) -> dict:
        known = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Date", date), ("WARC-Target-URI", uri),
                 ("WARC-Refers-To", source), ("WARC-Block-Digest", mark), ("Content-Type", content_type)]
        if beside:
            known.append(("WARC-Concurrent-To", beside))
        return dict(zip(FIELDS, (kind, own_id, source, beside, uri, date, content_type, len(content),
                                 mark, said or own, content.decode(), record(known, content), None)))

    return [made("metadata", meta_id, None, "application/warc-fields", about, about_digest),
            made("conversion", text_id, meta_id, "text/plain; charset=utf-8", text, text_digest)]


def derivatives(records: DataFrame, id_col: str = "page_id", warc_col: str = "warc",
                with_bytes: bool = True) -> DataFrame:
    """A row per derivative record: the id and ``FIELDS``; ``warc`` has the record as bytes."""
    kinds = {"content_length": pa.int64(), "warc": pa.binary()}
    parts = pa.struct([(f, kinds.get(f, pa.string())) for f in FIELDS])
    spark_kinds = {"content_length": "bigint", "warc": "binary"}
    kind = "array<struct<" + ",".join(f"{f}:{spark_kinds.get(f, 'string')}" for f in FIELDS) + ">>"

    @F.arrow_udf(kind)
    @giving_back
    def build(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [derive(x.as_py()) for x in column]
            if not with_bytes:
                for rows in found:
                    for row in rows:
                        row["warc"] = None
            yield pa.array(found, pa.list_(parts))

    built = in_small_batches(records).select(F.col(id_col).alias("page_id"), F.explode(build(warc_col)).alias("d"))
    return built.select("page_id", *[f"d.{f}" for f in FIELDS if with_bytes or f != "warc"])
