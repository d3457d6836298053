"""WARC derivatives: linked metadata and plain-text conversion records of responses (operator 8).

Every page becomes a ``response`` record (WARC/1.1); ``derive`` reads such records and builds two more from each:

* ``metadata`` (application/warc-fields): status, the source's HTTP headers under ``http-``, title, language, outlinks, and the
  source's payload and block digests;
* ``conversion`` (text/plain): the visible text.

Both carry WARC-Refers-To with the response's identifier, its target address and date, and digests of
their own.  Identifiers are name-based UUIDs, so a retried task writes the same records.  All steps are narrow maps;
``write`` packs records into gzip members of Parquet rows, which any store that Spark writes can hold.

Pages are read in one pass (``html.py``), so a page of unclosed tags takes no longer than another of its length.

Defined cases: a record without a Content-Length, or with none that is a number, has all that follows its headers as its block; a record that isn't a
response or has no identifier gives no derivatives (nulls), as nothing could refer to it; null html is an empty body; a null address leaves WARC-Target-URI out; control characters in header
values are percent-encoded, so no value can begin a new header; a block that isn't HTTP has no status and headers, and all of it is its
payload; texts are converted whole; repeated rows give equal records; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as html_lib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.llm import html as markup
from pixelloom.llm.arrow import bound_batches, kind_of, map_batches

#: Date of records whose source table has none.
NO_DATE = "1970-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pixelloom:warc")
_BLOCK = re.compile(r"(?ia)/?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|footer|header|main|blockquote|pre)\b")
_LINK, _HREF = re.compile(r"(?ia)a\s"), re.compile(r"(?ia)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _value(x: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", x)


def record(kind: str, name: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A WARC record; its identifier comes from ``name``, headers with a null value are left out."""
    own = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, kind + ' ' + name)}>"), *headers, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {_value(v)}\r\n" for k, v in own if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = headers.get("Content-Length", "")
    return headers, rest[: int(size)] if re.fullmatch("[0-9]{1,18}", size) else rest


def response(name: str, url: str | None, html: str | None, date: str = NO_DATE) -> bytes:
    body = (html or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    headers = [("WARC-Target-URI", url), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(body))]
    return record("response", name, headers, block)


def _text_and_links(html: str) -> tuple[str, list[str]]:
    """The visible text, and where its links lead."""
    out, links = [], []
    for text, tag in markup.parts(markup.without_hidden(html)):
        out.append(text)
        if tag is None:
            continue
        if _BLOCK.match(tag):
            out.append("\n")
        elif _LINK.match(tag) and (href := _HREF.search(tag)):
            links.append(html_lib.unescape(next(x for x in (*href.groups(), "") if x is not None)))
    lines = (" ".join(x.split()) for x in html_lib.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x), links


def plain_text(html: str) -> str:
    """The visible text: blocks on lines of their own, entities resolved, white space collapsed."""
    return _text_and_links(html)[0]


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *lines = head.decode("latin-1").split("\r\n")
    return first, [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines)], body


def derive(source: bytes) -> tuple[bytes, bytes] | tuple[None, None]:
    """(metadata record, conversion record) of a response record; nulls for any other."""
    own, block = parse_record(source)
    if own.get("WARC-Type") != "response" or not own.get("WARC-Record-ID"):
        return None, None
    status, http, body = _http(block)
    html = body.decode("utf-8", "replace")
    payload = own.get("WARC-Payload-Digest") or digest(body)
    title, lang = markup.title(html), markup.language(html)
    text, links = _text_and_links(html)
    fields = [("status", status), *((f"http-{k}", v) for k, v in http), ("source-payload-digest", payload), ("source-block-digest", own.get("WARC-Block-Digest", ""))]
    fields += [("title", " ".join(html_lib.unescape(title).split()))] if title is not None else []
    fields += [("language", lang)] if lang else []
    fields += [("outlink", x) for x in links]
    about = [("WARC-Refers-To", own["WARC-Record-ID"]), ("WARC-Refers-To-Target-URI", own.get("WARC-Target-URI")), ("WARC-Refers-To-Date", own.get("WARC-Date")), ("WARC-Target-URI", own.get("WARC-Target-URI")), ("WARC-Date", own.get("WARC-Date"))]
    metadata = "".join(f"{k}: {_value(v)}\r\n" for k, v in fields).encode()
    text = text.encode("utf-8", "replace")  # an entity can stand for half a character
    return (
        record("metadata", own["WARC-Record-ID"], [*about, ("Content-Type", "application/warc-fields")], metadata),
        record("conversion", own["WARC-Record-ID"], [*about, ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Payload-Digest", digest(text)), ("WARC-Source-Payload-Digest", payload)], text),
    )


def _responses(b: pa.RecordBatch) -> list[bytes]:
    """The response records of a batch of (id, address, html), named by id and address."""
    return [response(f"{i} {u}", u, h) for i, u, h in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]


def _derived(names: list[str], ids: pa.Array, records: list[bytes | None]) -> pa.RecordBatch:
    made = [derive(x) if x is not None else (None, None) for x in records]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.binary()) for x in (records, [m[0] for m in made], [m[1] for m in made]))], names=names)


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).cast("string"))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, record): each page as a response record, named by its id and address."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(_responses(b), pa.binary())], names=[id_col, "record"])

    picked = _pages(pages, id_col, url_col, html_col)
    return map_batches(picked, run, f"`{id_col}` {kind_of(picked, id_col)}, record binary")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What ``derivatives`` gives for the ``responses`` of pages, in one pass and by one set of workers."""
    names = [id_col, "record", "metadata", "conversion"]
    picked = _pages(pages, id_col, url_col, html_col)
    return map_batches(picked, lambda b: _derived(names, b.column(0), _responses(b)), f"`{id_col}` {kind_of(picked, id_col)}, record binary, metadata binary, conversion binary")


def derivatives(found: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, record, metadata, conversion): each response record with those derived from it; a null record, or one that has no derivatives, gives nulls."""

    names = [id_col, "record", "metadata", "conversion"]
    picked = found.select(F.col(id_col), "record")
    return map_batches(picked, lambda b: _derived(names, b.column(0), b.column(1).to_pylist()), f"`{id_col}` {kind_of(picked, id_col)}, record binary, metadata binary, conversion binary")


def read_back(found: DataFrame, id_col: str = "page_id") -> DataFrame:
    """What the derived records say, parsed: identifiers, links, digests and the text."""
    names = [id_col, "response_id", "metadata_id", "metadata_refers_to", "conversion_id", "conversion_refers_to", "target_uri", "source_digest", "text_digest", "outlinks", "text"]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for source, metadata, conversion in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            (s, _), (m, fields), (c, text) = (parse_record(x) for x in (source, metadata, conversion))
            out.append((s["WARC-Record-ID"], m["WARC-Record-ID"], m["WARC-Refers-To"], c["WARC-Record-ID"], c["WARC-Refers-To"], c.get("WARC-Target-URI"), c["WARC-Source-Payload-Digest"], c["WARC-Payload-Digest"], fields.count(b"\r\noutlink: "), text.decode()))
        kinds = [*[pa.string()] * 8, pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))], names=names)

    kinds = ["string"] * 8 + ["long", "string"]
    picked = found.where("metadata is not null and conversion is not null").select(F.col(id_col), "record", "metadata", "conversion")
    return map_batches(picked, run, f"`{id_col}` {kind_of(picked, id_col)}, " + ", ".join(f"{n} {k}" for n, k in zip(names[1:], kinds, strict=True)))


def write(found: DataFrame, path: str) -> None:
    """The derived records as gzip members, one a record, in Parquet rows (id, kind, member)."""

    bound_batches(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, kind in ((2, "metadata"), (3, "conversion")):
                members = [gzip.compress(x, 6, mtime=0) if x is not None else None for x in b.column(i).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([kind] * b.num_rows), pa.array(members, pa.binary())], names=["id", "kind", "member"])

    first = found.columns[0]
    found.mapInArrow(run, f"id {kind_of(found, first)}, kind string, member binary").write.parquet(path)
