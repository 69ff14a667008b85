"""Responses with chunks and content encodings."""

import gzip
import zlib

from corpweave.llm import warc

PAGE = "<p>Grüße an alle</p>".encode()


def response(body, *headers):
    block = b"\r\n".join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", *headers]) + b"\r\n\r\n" + body
    return warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block)


def chunked(body):
    cut = [body[i:i + 7] for i in range(0, len(body), 7)]
    return b"".join(b"%x;a=b\r\n%s\r\n" % (len(c), c) for c in cut) + b"0\r\nTrailer: x\r\n\r\n"


def test_encodings_are_undone(spark):
    raw = zlib.compressobj(wbits=-15)
    good = [response(PAGE), response(chunked(PAGE), b"Transfer-Encoding: Chunked"),
            response(gzip.compress(PAGE[:9]) + gzip.compress(PAGE[9:]), b"Content-Encoding: x-gzip"),
            response(zlib.compress(PAGE), b"Content-Encoding: deflate"),
            response(raw.compress(PAGE) + raw.flush(), b"Content-Encoding: identity, deflate"),
            response(chunked(zlib.compress(gzip.compress(PAGE))), b"Transfer-Encoding: chunked", b"Content-Encoding: gzip, deflate"),
            response(chunked(gzip.compress(PAGE)), b"Transfer-Encoding: gzip, chunked")]
    bad = [response(PAGE, b"Content-Encoding: br"), response(PAGE, b"Content-Encoding: gzip"), response(b"", b"Content-Encoding: br"),
           response(gzip.compress(PAGE)[:-9], b"Content-Encoding: gzip"), response(chunked(PAGE)[:20], b"Transfer-Encoding: chunked"),
           response(PAGE, b"Transfer-Encoding: chunked")]
    frame = spark.createDataFrame(list(enumerate(good + bad)), "page_id int, warc binary")
    found = warc.derivatives(frame).collect()
    texts = {r["page_id"]: r["content"] for r in found if r["record_type"] == "conversion"}
    assert texts == {i: "Grüße an alle" for i in range(len(good))}
    assert sorted(r["page_id"] for r in found if r["problem"]) == list(range(len(good), len(good + bad)))
    empty = warc.derive(response(b"", b"Content-Encoding: gzip"))
    assert [r["content"] for r in empty if r["record_type"] == "conversion"] == [""]
