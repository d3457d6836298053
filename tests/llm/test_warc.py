import base64
import gzip
import hashlib
import re
import time
from html.parser import HTMLParser

from pixelloom.llm import warc as W

PAGE = """<!DOCTYPE html><html lang="de-AT"><head><title>A &amp; B\n c</title><script>var t="</p>";</script></head><body><!-- x --><nav><a href="/one">One</a><a class=y href='two'>Two</a></nav>
<div>Hello   <b>wor</b>ld &lt;ok&gt;<br>next</div><style>p{}</style><p>é</p></body></html>"""


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_are_linked_and_whole():
    source = W.response("1 u", "http://a/\r\nX: 1", PAGE)
    head, block = W.parse_record(source)
    assert head["WARC-Target-URI"] == "http://a/%0D%0AX: 1" and head["WARC-Payload-Digest"] == sha(PAGE.encode()) and head["WARC-Block-Digest"] == sha(block)
    metadata, conversion = W.derive(source)
    (m, fields), (c, text) = W.parse_record(metadata), W.parse_record(conversion)
    assert m["WARC-Refers-To"] == c["WARC-Refers-To"] == head["WARC-Record-ID"] and len({m["WARC-Record-ID"], c["WARC-Record-ID"], head["WARC-Record-ID"]}) == 3
    assert text.decode() == "OneTwo\nHello world <ok>\nnext\né"
    assert c["WARC-Payload-Digest"] == sha(text) and c["WARC-Source-Payload-Digest"] == head["WARC-Payload-Digest"]
    lines = fields.decode().split("\r\n")
    assert {"status: HTTP/1.1 200 OK", "http-content-type: text/html; charset=utf-8", "title: A & B c", "language: de-AT", "outlink: /one", "outlink: two", f"source-payload-digest: {sha(PAGE.encode())}"} <= set(lines)
    assert W.derive(source) == (metadata, conversion)
    assert re.fullmatch(rb"WARC/1\.1\r\n.*\r\n\r\n", conversion, re.S)


def test_frames(spark, tmp_path):
    rows = [(1, "http://a/", PAGE, 0), (2, None, None, 0), (3, "u", "", 0), (3, "u", "", 0), (None, "v", "<p>x" * 50_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record int")
    made = W.derivatives(W.responses(df))
    assert sorted(map(repr, W.records(df).collect())) == sorted(map(repr, made.collect()))
    got = sorted(((r.page_id, r.target_uri, r.outlinks, r.text) for r in W.read_back(made).collect()), key=str)
    assert got == sorted([(1, "http://a/", 2, W.plain_text(PAGE)), (2, None, 0, ""), (3, "u", 0, ""), (3, "u", 0, ""), (None, "v", 0, "\n".join("x" * 50_000))], key=str)
    W.write(made, f"file://{tmp_path}/w")
    back = spark.read.parquet(f"file://{tmp_path}/w").collect()
    assert sorted(gzip.decompress(r.member) for r in back) == sorted(bytes(x) for r in made.collect() for x in (r.metadata, r.conversion))
    assert W.read_back(W.derivatives(W.responses(df.limit(0)))).count() == 0
    none = spark.createDataFrame([(1, None)], "page_id long, record binary")
    assert W.derivatives(none).first().metadata is None


def test_malformed_records(spark):
    """No identifier, no length, no header at all, another type, a cut record: a defined result, never an error."""
    good = W.response("1 u", "http://a/", PAGE)
    assert W.derive(b"") == W.derive(b"\r\n\r\n") == W.derive(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nx") == (None, None)
    assert W.derive(good.replace(b"WARC-Type: response", b"WARC-Type: request")) == (None, None)
    assert W.parse_record(b"WARC/1.1\r\nContent-Length: -3\r\n\r\nabc")[1] == W.parse_record(b"WARC/1.1\r\n\r\nabc")[1] == b"abc"
    for cut in range(0, len(good), 7):
        metadata, conversion = W.derive(good[:cut])
        assert (metadata is None) == (conversion is None)
    no_length = re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"\r\nHTTP", good)
    assert b"Hello world" in W.derive(no_length)[1]
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"")), (3, bytearray(b"junk")), (4, None)], "page_id long, record binary")
    made = W.derivatives(df)
    assert sorted(r.page_id for r in made.where("metadata is null").collect()) == [2, 3, 4]
    assert [r.page_id for r in W.read_back(made).collect()] == [1]


class Seen(HTMLParser):
    """An independent reading of a page: its visible text by the standard library's parser."""

    HIDDEN = {"script", "style", "head", "template", "noscript"}
    BLOCKS = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "section", "article", "nav", "footer", "header", "main", "blockquote", "pre"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.links, self.inside = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.inside.append(tag)
        elif not self.inside:
            self.out.append("\n" if tag in self.BLOCKS else "")
            if tag == "a" and "href" in dict(attrs):
                self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        if self.inside and tag == self.inside[-1]:
            self.inside.pop()
            self.out.append(" ")
        elif not self.inside and tag in self.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


def test_pages_equal_an_independent_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in W.read_back(W.derivatives(W.responses(pages))).collect()}
    rows = pages.collect()
    assert len(rows) == len(got)
    for r in rows:
        seen = Seen()
        seen.feed(r.html or "")
        seen.close()
        lines = [" ".join(x.split()) for x in "".join(seen.out).split("\n")]
        own = got[r.page_id]
        assert own.text == "\n".join(x for x in lines if x) and own.outlinks == len(seen.links)
        assert own.target_uri == r.url and own.source_digest == sha((r.html or "").encode()) and own.text_digest == sha(own.text.encode())
        assert own.metadata_refers_to == own.conversion_refers_to == own.response_id


def test_hostile_pages_take_linear_time():
    for page in ("<script>" * 130_000, "<" * 1_000_000, "<!--" * 250_000, "<a " * 330_000, "<title>" * 150_000, "<html " * 160_000, "<p" * 400_000, "<a href=" * 120_000, "lang=" * 100_000):
        began = time.time()
        W.derive(W.response("1", "u", page))
        assert time.time() - began < 5
