"""WARC derivative builder: metadata and conversion records of response records.

Records are WARC/1.1: a version line, named fields, an empty line, the block and
two empty lines, each line ended by CR LF.  A response's block is an HTTP
response.  From every response record two are derived:

* ``metadata``: a JSON block with the response's own WARC fields and HTTP
  headers (names and order kept), its digests, its title and its links;
* ``conversion``: the page as plain text.

Both carry ``WARC-Refers-To`` (the response's id), its target URI and date, and
digests of their own block; the metadata record also names the conversion's id.
Ids are derived from the record they refer to, so a task that runs again makes
the same records.  Digests are ``sha1:`` in base 32.

Plain text: comments, scripts, styles, templates, ``noscript`` and the head go;
block elements end a line; other tags go; character references are resolved;
white space is folded and empty lines go.  The head ends at ``</head>`` or, where
that is left out, at the first element that cannot stand in one.  A comment or one
of the other elements that is never closed goes to the page's end.  A tag ends at
the first ``>``.  The page is scanned once, in time linear in its length.  Title
and links are those of elements outside comments and scripts.

Defined cases: a null page is an empty body, a null URL no target URI; control
characters and spaces in a URL are percent-encoded; records of other types and
malformed records are not derived from (``parse`` gives None); repeated rows
give equal records each; an empty table gives no records; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.storage import Work

VERSION = "WARC/1.1"
CRLF = b"\r\n"
RECORDS = "page_id {id}, type string, record_id string, refers_to string, record binary"

# Element names of HTML.
_DROPPED = {"script", "style", "template", "noscript"}
_IN_HEAD = _DROPPED | {"html", "head", "title", "meta", "link", "base"}
_BLOCK = set("address article aside blockquote br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
             "li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
# Searched only where a later '>' exists, so no attempt runs to the page's end.
_TOKEN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)")
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*_DROPPED, "title")}


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def build(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record; ``Content-Length`` is added."""
    head = [VERSION, *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def parse(record: bytes) -> tuple[list[tuple[str, str]], bytes] | None:
    """Fields and block of a record; None if it is not one."""
    head, sep, rest = record.partition(CRLF * 2)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        return None
    fields = [(k.strip(), v.strip()) for k, c, v in (x.partition(":") for x in lines[1:]) if c]
    length = next((v for k, v in fields if k.lower() == "content-length"), "")
    if not length.isdigit() or len(rest) < int(length):
        return None
    return fields, rest[:int(length)]


def field(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def response(page_id, url: str | None, body: str | None, date: str) -> tuple[str, bytes]:
    """``(record id, record)`` of a fetched page."""
    payload = (body or "").encode()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{url}\n{page_id}\n{digest(payload)}")
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + CRLF * 2 + payload)
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date),
              *([("WARC-Target-URI", _uri(url))] if url is not None else []),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block))]
    return f"<urn:uuid:{name}>", build(fields, block)


def scan(page: str) -> tuple[str, str | None, list[str]]:
    """Raw text (tags gone, block elements as line ends), title and links of a page."""
    out, links, title = [], [], None
    pos, end, in_head, closable = 0, page.rfind(">") + 1, False, True
    while True:
        m = _TOKEN.search(page, pos, end)
        if m is None:
            break
        if not in_head:
            out.append(page[pos:m.start()])
        pos = m.end()
        if m[1]:
            close = page.find("-->", m.end())
            if close < 0:
                return "".join(out), title, links
            pos = close + 3
            continue
        if m[3] is None:
            continue
        name, closing = m[3].lower(), m[2] == "/"
        if in_head:
            in_head = name in _IN_HEAD and not (closing and name == "head")
            if closing and name == "head":
                continue
        elif name == "head" and not closing:
            in_head = True
            continue
        if not closing and name in _DROPPED:
            close = _CLOSE[name].search(page, pos, end)
            if close is None:
                return "".join(out), title, links
            pos = close.end()
        elif name == "title" and not closing and closable:
            close = _CLOSE["title"].search(page, pos, end)
            closable = close is not None
            if close is not None:
                if title is None:
                    title = page[pos:close.start()]
                if not in_head:
                    out.append(page[pos:close.start()])
                pos = close.end()
        elif name == "a" and not closing:
            href = _HREF.search(m[4])
            value = href and (href[1] or href[2] or href[3])
            if value:
                links.append(value)
        elif name in _BLOCK:
            out.append("\n")
    rest = page[pos:]
    comment = rest.find("<!--")
    if not in_head:
        out.append(rest if comment < 0 else rest[:comment])
    return "".join(out), title, links


def folded(text: str) -> str:
    """Plain text of ``scan``'s raw text."""
    lines = (" ".join(x.split()) for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def plain_text(page: str) -> str:
    return folded(scan(page)[0])


def _derived_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>"


def derive(record: bytes) -> list[tuple[str, str, str, bytes]]:
    """``(type, record id, refers to, record)`` of what a response record gives."""
    parsed = parse(record)
    if parsed is None or field(parsed[0], "WARC-Type") != "response":
        return []
    fields, block = parsed
    source = field(fields, "WARC-Record-ID")
    if source is None:
        return []
    head, _, payload = block.partition(CRLF * 2)
    status, *headers = head.decode("utf-8", "replace").split("\r\n")
    page = payload.decode("utf-8", "replace")
    kept = [(k, field(fields, k)) for k in ("WARC-Target-URI", "WARC-Date")]
    kept = [(k, v) for k, v in kept if v is not None]
    names = {kind: _derived_id(source, kind) for kind in ("metadata", "conversion")}
    text, title, links = scan(page)
    meta = json.dumps({
        "warc": [list(x) for x in fields], "status": status,
        "http": [[k.strip(), v.strip()] for k, c, v in (x.partition(":") for x in headers) if c],
        "payload-digest": field(fields, "WARC-Payload-Digest"), "computed-payload-digest": digest(payload),
        "title": " ".join(html.unescape(title).split()) if title is not None else None,
        "links": [html.unescape(x) for x in links],
        "conversion": names["conversion"]}, ensure_ascii=False).encode()
    out = []
    for kind, mime, body in (("metadata", "application/json", meta),
                             ("conversion", "text/plain; charset=utf-8", folded(text).encode())):
        out.append((kind, names[kind], source, build(
            [("WARC-Type", kind), ("WARC-Record-ID", names[kind]), *kept, ("WARC-Refers-To", source),
             ("Content-Type", mime), ("WARC-Block-Digest", digest(body))], body)))
    return out


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id",
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of fetched pages (``RECORDS``)."""
    Work(pages.sparkSession, "warc")
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in (part for whole in batches for part in K.byte_slices(whole, "html")):
            made = [response(*x, date) for x in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column(0), "type": pa.array(["response"] * len(made), pa.string()),
                "record_id": pa.array([x[0] for x in made], pa.string()),
                "refers_to": pa.nulls(len(made), pa.string()), "record": pa.array([x[1] for x in made], pa.binary())})

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(run, RECORDS.format(id=id_type))


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records among ``records``."""
    Work(records.sparkSession, "warc")
    id_type = records.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in (part for whole in batches for part in K.byte_slices(whole, "record")):
            rows = [(i, *x) for i, r in enumerate(batch.column("record").to_pylist()) if r is not None
                    for x in derive(r)]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id").take(pa.array(cols[0], pa.int64())),
                **{n: pa.array(c, pa.string()) for n, c in zip(("type", "record_id", "refers_to"), cols[1:4])},
                "record": pa.array(cols[4], pa.binary())})

    return records.select("page_id", "record").mapInArrow(run, RECORDS.format(id=id_type))


def read_back(records: DataFrame) -> DataFrame:
    """Parsed records: fields that link them and their blocks."""
    Work(records.sparkSession, "warc")
    id_type = records.schema["page_id"].dataType.simpleString()
    names = {"type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
             "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "block_digest": "WARC-Block-Digest"}

    def run(batches):
        for batch in (part for whole in batches for part in K.byte_slices(whole, "record")):
            rows = [parse(r) or ([], b"") for r in batch.column("record").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"),
                **{n: pa.array([field(f, k) for f, _ in rows], pa.string()) for n, k in names.items()},
                "digest_ok": pa.array([field(f, "WARC-Block-Digest") == digest(b) for f, b in rows]),
                "block": pa.array([b.decode("utf-8", "replace") for _, b in rows], pa.string())})

    return records.select("page_id", "record").mapInArrow(
        run, f"page_id {id_type}, " + ", ".join(f"{n} string" for n in names) + ", digest_ok boolean, block string")


def write_files(records: DataFrame, path: str, per_file: int = 4096) -> None:
    """WARC files of at most ``per_file`` records each, one record after another."""
    body = F.expr("substring(record, 1, octet_length(record) - 4)").cast("string")
    records.where("record is not null").select(body.alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


def split_records(data: bytes) -> list[bytes]:
    """The records of a WARC file, cut by their ``Content-Length``."""
    out, at = [], 0
    while at < len(data):
        head = data.find(CRLF * 2, at)
        length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", data[at:head].replace(CRLF, b"\n")) if head >= 0 else None
        if length is None:
            raise ValueError(f"no WARC record at byte {at}")
        end = head + 4 + int(length[1]) + 4
        out.append(data[at:end])
        at = end
    return out


def read_files(spark, path: str) -> DataFrame:
    """``page_id`` (null: files do not have it) and ``record`` of the WARC files below ``path``."""
    Work(spark, "warc")

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                records = split_records(data.as_py())
                yield pa.RecordBatch.from_pydict({"page_id": pa.nulls(len(records), pa.int64()),
                                                  "record": pa.array(records, pa.binary())})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id long, record binary")


def summary(pages: DataFrame, **columns) -> DataFrame:
    """One row per page, read back from its derived records."""
    read = read_back(derivatives(responses(pages, **columns)))
    meta = "$.{}".format
    return read.select(
        "page_id", "type", "record_id", "refers_to", "target_uri", "warc_date", "block_digest", "digest_ok",
        F.when(F.col("type") == "conversion", F.sha2(F.col("block").cast("binary"), 256)).alias("text_sha256"),
        F.when(F.col("type") == "conversion", F.length("block")).cast("long").alias("text_chars"),
        F.when(F.col("type") == "metadata", F.get_json_object("block", meta("payload-digest"))).alias("payload_digest"),
        F.when(F.col("type") == "metadata", F.get_json_object("block", meta("conversion"))).alias("conversion_id"),
        F.when(F.col("type") == "metadata", F.get_json_object("block", meta("title"))).alias("title"),
        F.when(F.col("type") == "metadata", F.json_array_length(F.get_json_object("block", meta("links"))))
        .cast("long").alias("n_links"))
