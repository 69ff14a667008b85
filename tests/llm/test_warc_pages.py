"""Pages of open tags, against plain patterns that are quadratic on them."""

import gzip
import html
import random
import re
import time

import pytest

from corpweave.llm import warc
from tests.llm.test_warc_encodings import response

HIDDEN = re.compile(r"<(script|style|noscript|template|title)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINK = re.compile(r"""<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
BITS = ["<script>", "</script >", "<STYLE x", "</style>", "<!--", "-->", "<title>", "<title", "</title>", ">", "<", "<a ", "<a\n",
        "<b>", "</p>", "<p class=x", "href=", "HREF = ", "hrefs", '"', "'", " ", "\n", "x", "&amp;", "/y?z", "=", "ü"]


def plain(page):
    page = HIDDEN.sub("", page)
    page = html.unescape(warc._TAG.sub("", warc._BLOCK.sub("\n", page)))
    return "\n".join(line for line in (" ".join(x.split()) for x in page.split("\n")) if line)


def test_equal_to_plain_patterns_on_random_pages():
    random.seed(3)
    for _ in range(30_000):
        page = "".join(random.choices(BITS, k=random.randint(0, 25)))
        assert warc.plain_text(page) == plain(page), page
        assert list(warc.links(page)) == [m[1] or m[2] or m[3] or "" for m in LINK.finditer(page)], page
        assert warc.title_of(page) == ((m := TITLE.search(page)) and m[1]), page


@pytest.mark.parametrize("bit", ["<script>", "<!--", "<a ", "<title>", "<title", "<p", "<x", "<a href='", '<a href="x ', "<a href ", "</script "])
def test_a_million_bytes_of_open_tags(bit):
    begun = time.process_time()
    made = warc.derive(response((bit * (1_000_000 // len(bit))).encode()))
    assert [r["record_type"] for r in made] == ["metadata", "conversion"]
    assert time.process_time() - begun < 5


def test_what_a_body_unpacks_to_is_bounded(monkeypatch):
    monkeypatch.setattr(warc, "MOST_BYTES", 1000)
    encoded = lambda n: response(gzip.compress(b"a" * n), b"Content-Encoding: gzip")
    assert [r["content_length"] for r in warc.derive(encoded(1000))][1] == 1000
    assert [r["problem"] for r in warc.derive(encoded(1001))] == ["encoded body too large"]
    two = gzip.compress(b"a" * 600) * 2
    assert warc.derive(response(two, b"Content-Encoding: gzip"))[0]["problem"] == "encoded body too large"
