import hashlib
import json
import time
from html.parser import HTMLParser

import pyarrow as pa

from conftest import SF001
from sparkcount.llm import kernels as K
from sparkcount.llm import op05_warc_derive as op
from sparkcount.llm import queries as Q

PAGE = ("<!DOCTYPE html><html><head><title>A &amp; B\n</title><style>p{}</style><script>var t='</p>';</script></head>"
        "<body><!-- no <p> --><h1>Head</h1><p>one <b>two</b>&nbsp;&lt;3<br>line 2<a href='/x?a=1&amp;b'>link</a>"
        "<noscript>hid</noscript><a class=k HREF=\"/é\">z</a> 1 < 2</body></html>")


def test_plain_text():
    assert op.plain_text(PAGE) == "Head\none two <3\nline 2linkz 1 < 2"
    assert op.plain_text("") == "" and op.plain_text("<script>never closed") == ""
    assert op.plain_text("no tags at all") == "no tags at all"


def test_records_parse_and_refer():
    name, record = op.response(1, "http://h/a b\r\nX: y", PAGE, "2020-01-02T03:04:05Z")
    fields, block = op.parse(record)
    assert op.field(fields, "warc-target-uri") == "http://h/a%20b%0D%0AX:%20y"
    assert op.field(fields, "WARC-Record-ID") == name and op.field(fields, "WARC-Block-Digest") == op.digest(block)
    meta, conv = op.derive(record)
    for kind, record_id, refers, raw in (meta, conv):
        f, b = op.parse(raw)
        assert op.field(f, "WARC-Refers-To") == name == refers and op.field(f, "WARC-Type") == kind
        assert op.field(f, "WARC-Date") == "2020-01-02T03:04:05Z" and op.field(f, "WARC-Block-Digest") == op.digest(b)
    body = json.loads(op.parse(meta[3])[1])
    assert body["warc"] == [list(x) for x in fields] and body["conversion"] == conv[1]
    assert body["payload-digest"] == body["computed-payload-digest"] == op.digest(PAGE.encode())
    assert body["title"] == "A & B" and body["links"] == ["/x?a=1&b", "/é"]
    assert body["http"][0] == ["Content-Type", "text/html; charset=utf-8"]
    assert op.parse(conv[3])[1].decode() == op.plain_text(PAGE)


def test_other_and_broken_records_give_nothing():
    _, record = op.response(1, None, None, "d")
    assert [k for k, *_ in op.derive(record)] == ["metadata", "conversion"]
    assert op.derive(op.derive(record)[0][3]) == []
    for broken in (b"", b"WARC/1.1", record[:-30], b"HTTP/1.1 200 OK\r\n\r\n", b"WARC/1.1\r\nContent-Length: x\r\n\r\n"):
        assert op.parse(broken) is None and op.derive(broken) == []


def test_tables(spark):
    rows = [(1, "http://a", PAGE, "x", 1), (2, None, None, "x", 1), (3, "u", "", "x", 1), (None, "http://a", "<p>p", "x", 1),
            (4, "http://a", PAGE * 500, "x", 1), (1, "http://a", PAGE, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string, type int")
    got = op.summary(pages).collect()
    assert len(got) == 2 * len(rows) and all(r.digest_ok for r in got)
    text = {r.page_id: r.text_sha256 for r in got if r.type == "conversion"}
    assert text[1] == hashlib.sha256(op.plain_text(PAGE).encode()).hexdigest()
    assert text[2] == hashlib.sha256(b"").hexdigest()
    ids = {r.record_id: r for r in got if r.type == "conversion"}
    assert all(ids[r.conversion_id].refers_to == r.refers_to for r in got if r.type == "metadata")
    assert op.summary(pages.limit(0)).count() == 0


def test_query_covers_all_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = [r for r in Q.op5_warc_derive(spark, SF001).collect() if r.type == "conversion"]
    assert {r.page_id: r.text_sha256 for r in got} == {
        i: hashlib.sha256(op.plain_text(h or "").encode()).hexdigest() for i, h in pages.items()}


BLOCKS = set("address article aside blockquote br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
             "li main nav ol p pre section table tbody td tfoot th thead tr ul".split())


class Reader(HTMLParser):
    """The same rules on the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.title, self.links, self.skip, self.in_title = [], None, [], [], False

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "template", "noscript", "head"):
            self.skip.append(tag)
        elif self.skip and self.skip[-1] == "head" and tag not in ("title", "meta", "link", "base"):
            self.skip.pop()
        if tag == "title":
            self.in_title, self.title = True, self.title if self.title is not None else ""
        if not self.skip:
            if tag in BLOCKS:
                self.out.append("\n")
            self.links += [v for k, v in attrs if k == "href" and v] if tag == "a" else []

    def handle_endtag(self, tag):
        if self.skip and self.skip[-1] == tag:
            self.skip.pop()
        if tag == "title":
            self.in_title = False
        if not self.skip and tag in BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if not self.skip:
            self.out.append(data)


def read(page):
    r = Reader()
    r.feed(page)
    r.close()
    lines = (" ".join(x.split()) for x in "".join(r.out).split("\n"))
    return "\n".join(x for x in lines if x), r.title and " ".join(r.title.split()), r.links


def test_pages_against_the_standard_parser(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect() if r.html]
    pages += [PAGE.replace("1 < 2", "1 2"), "<html><head><title>t</title><body><p>all of the page</p>",
              "<head><meta charset=x><link href=y><div>in</div> out <a href=z>q</a>", "<p>a<br/>b<hr>c</p><ul><li>x<li>y</ul>",
              "<title>only</title>", "<div><noscript><p>no</p></noscript>yes</div>"]
    for page in pages:
        text, title, links = op.scan(page)
        want = read(page)
        assert op.folded(text) == want[0], page[:300]
        assert (title and " ".join(op.html.unescape(title).split())) == want[1]
        assert [op.html.unescape(x) for x in links] == want[2]


def test_unclosed_elements():
    assert op.plain_text("<html><head><title>t</title><body><p>all of the page</p>") == "all of the page"
    assert op.plain_text("<head><style>x</style><h1>a</h1>b") == "a\nb"
    assert op.plain_text("a<!-- never <p>b</p>") == "a" and op.plain_text("a<p>b <c") == "a\nb <c"
    assert op.plain_text("x<script>var a = '<p>'") == "x" and op.plain_text("<title>open <p>x") == "open\nx"
    assert op.scan("<!-- <title>no</title> <a href=n> --><title>yes</title>")[1:] == ("yes", [])


def test_hostile_pages_take_linear_time():
    for piece in ("<a ", "<title>", "<!--", "<p ", "<script>", "</script ", "<head>", "<a href=", "<", "&", "<head><title>",
                  "<noscript>x</noscript", "href=", "<a href='", "<p><title>"):
        for page in (piece * (1_000_000 // len(piece)), piece * (1_000_000 // len(piece)) + ">"):
            t = time.perf_counter()
            op.folded(op.scan(page)[0])
            assert time.perf_counter() - t < 3, piece


def test_records_through_warc_files(spark, scratch):
    rows = [(1, "http://a", PAGE), (2, None, None), (3, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (4, "é", "é" * 5000)] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = op.responses(pages)
    records = made.unionByName(op.derivatives(made))
    op.write_files(records, f"{scratch}/warc", per_file=5)
    back = op.read_files(spark, f"{scratch}/warc")
    want = sorted(bytes(r.record) for r in records.collect())
    assert sorted(bytes(r.record) for r in back.collect()) == want and len(want) == 36
    assert all(r.digest_ok for r in op.read_back(back).collect())


def test_pages_go_in_slices_of_bytes():
    batch = pa.RecordBatch.from_pydict({"html": pa.array(["a" * 10, None, "", "b" * 500, "c", None, "d" * 99, "e"]), "n": list(range(8))})
    parts = [p.column("n").to_pylist() for p in K.byte_slices(batch, "html", 100)]
    assert parts == [[0, 1, 2], [3], [4, 5, 6], [7]]
    assert list(K.byte_slices(batch.slice(0, 0), "html")) == []
    assert [p.column("n").to_pylist() for p in K.byte_slices(batch.slice(3, 2), "html", 100)] == [[3], [4]]
