"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response gives one ``metadata`` record (``application/warc-fields``: the
source's headers, digests, title and links) and, where its payload is text, one
``conversion`` record (``text/plain``: the text a reader sees). Both name the
response in ``WARC-Refers-To`` and keep its target, date and payload digest. Ids
derive from the response's id, so a rerun or a lost executor gives the same
records. Row-wise: no shuffle, and ``record`` holds the bytes ready to be written.

``read_responses`` reads WARC files; ``page_responses`` makes response records of
a table of pages.

Defined results: a null payload is empty; a null url leaves the target header out;
a block without an HTTP header end is all payload with status 0; text is decoded
by the declared charset, else UTF-8, undecodable bytes replaced; other payload
types get a metadata record only. Rows that repeat an id give their records again.
Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.page_tree import INLINE, RAW_TEXT, Element, parse

# fixed values: names of the format
VERSION = "WARC/1.0"
RESPONSE_TYPE = "application/http; msgtype=response"
METADATA_TYPE = "application/warc-fields"
CONVERSION_TYPE = "text/plain; charset=utf-8"
CAPTURE_DATE = "2024-01-01T00:00:00Z"

RESPONSES = "record_id string, target_uri string, date string, headers string, payload_digest string, block binary"
DERIVATIVES = ("warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
               "content_length long, block_digest string, payload_digest string, block binary, record binary")
HREF = re.compile(r"(?:^|\s)href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
SPACE = re.compile(r"[ \t\n\v\f\r]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def serialise(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{k}: {one_line(v)}" for k, v in headers if v is not None]]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def one_line(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


def visible_text(tree: Element) -> str:
    """All text a reader sees, blocks and line breaks as lines."""
    lines: list[str] = []
    run: list[str] = []

    def end_line():
        text = SPACE.sub(" ", "".join(run)).strip()
        if text:
            lines.append(text)
        run.clear()

    stack = [(tree, iter(tree.content))]
    while stack:
        element, rest = stack[-1]
        for x in rest:
            if isinstance(x, str):
                run.append(html.unescape(x))
            elif x.tag not in RAW_TEXT:
                if x.tag not in INLINE or x.tag == "br":
                    end_line()
                stack.append((x, iter(x.content)))
                break
        else:
            stack.pop()
            if element.tag not in INLINE:
                end_line()
    end_line()
    return "\n".join(lines)


def title_and_links(tree: Element) -> tuple[str, list[str]]:
    title, links = "", []
    todo = [tree]
    while todo:
        e = todo.pop()
        if e.tag == "title" and not title:
            title = SPACE.sub(" ", html.unescape("".join(x for x in e.content if isinstance(x, str)))).strip()
        elif e.tag == "a" and (m := HREF.search(e.attributes)):
            links.append(html.unescape(m[1].strip("\"'")))
        todo += [x for x in reversed(e.content) if isinstance(x, Element)]
    return title, links


def http_parts(block: bytes) -> tuple[int, list[tuple[str, str]], bytes]:
    """Status, headers and payload of an HTTP response block."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return 0, [], block
    first, *lines = head.decode("latin-1").split("\r\n")
    status = first.split(" ")[1:2]
    headers = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
    return int(status[0]) if status and status[0].isdigit() else 0, headers, payload


def decode_text(payload: bytes, content_type: str) -> str:
    m = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I)
    try:
        return payload.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(record: dict) -> Iterator[tuple]:
    """The derivative records of one response."""
    source = record["record_id"] or ""
    target, date = record["target_uri"], record["date"]
    block = record["block"] or b""
    status, headers, payload = http_parts(block)
    payload_digest = record["payload_digest"] or digest(payload)
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    essence = kind.split(";")[0].strip().lower()
    is_page, is_text = essence in ("text/html", "application/xhtml+xml"), essence == "text/plain"
    text = decode_text(payload, kind) if is_page or is_text else ""
    tree = parse(text) if is_page else None
    fields = [("source-record-id", source), ("source-block-digest", digest(block)), ("source-payload-digest", payload_digest),
              ("http-status", str(status)), *[(f"http-header-{k.lower()}", v) for k, v in headers]]
    fields += [("source-header", h) for h in (record["headers"] or "").split("\r\n") if h]
    if tree is not None:
        title, links = title_and_links(tree)
        fields += [("title", title), *[("outlink", x) for x in links]]
    about = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields).encode("utf-8", "replace")
    outputs = [("metadata", METADATA_TYPE, about)]
    if is_page or is_text:
        outputs.append(("conversion", CONVERSION_TYPE, (visible_text(tree) if is_page else text).encode("utf-8", "replace")))
    for warc_type, content_type, data in outputs:
        name, sum_ = record_id(source, warc_type), digest(data)
        full = serialise([("WARC-Type", warc_type), ("WARC-Record-ID", name), ("WARC-Refers-To", source or None),
                          ("WARC-Target-URI", target), ("WARC-Date", date), ("WARC-Block-Digest", sum_),
                          ("WARC-Payload-Digest", payload_digest), ("Content-Type", content_type),
                          ("Content-Length", str(len(data)))], data)
        yield warc_type, name, record["record_id"], target, date, content_type, len(data), sum_, payload_digest, data, full


def derivatives(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Metadata and conversion records of response records, and the ``keep`` columns of their response."""
    kept = responses.select(*[F.col(c).alias(f"__{c}") for c in keep], *[x.split(" ")[0] for x in RESPONSES.split(", ")])
    names = [x.split(" ")[0] for x in DERIVATIVES.split(", ")]
    kinds = [pa.int64() if "length" in x else pa.binary() if x.endswith("binary") else pa.string() for x in DERIVATIVES.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                rows, owner = [], []
                for i, record in enumerate(part.select([n for n in part.schema.names if not n.startswith("__")]).to_pylist()):
                    found = list(derive(record))
                    rows += found
                    owner += [i] * len(found)
                owner = pa.array(owner, pa.int64())
                columns = {n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds))}
                yield pa.record_batch({**{f"__{c}": part.column(f"__{c}").take(owner) for c in keep}, **columns})

    kept_types = "".join(f"__{c} {kept.schema[f'__{c}'].dataType.simpleString()}, " for c in keep)
    made = kept.mapInArrow(build, kept_types + DERIVATIVES)
    return made.select(*[F.col(f"__{c}").alias(c) for c in keep], *names)


def page_responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html",
                   date: str = CAPTURE_DATE) -> DataFrame:
    """Response records of a table of pages; ids derive from page id, url and content."""
    payload = F.coalesce(F.col(page), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    key = F.md5(F.concat_ws("\0", F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit("")), F.md5(payload)).cast("binary"))
    name = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    return pages.select(F.col(page_id).alias("page_id"), name.alias("record_id"), F.col(url).alias("target_uri"), F.lit(date).alias("date"),
                        F.concat(F.lit(f"WARC-Type: response\r\nContent-Type: {RESPONSE_TYPE}\r\nWARC-Record-ID: "), name).alias("headers"),
                        F.lit(None).cast("string").alias("payload_digest"), F.concat(head.cast("binary"), payload).alias("block"))


def split_records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of every record of a WARC file's bytes; a torn last record raises."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
        length = int(next(v for k, v in headers if k.lower() == "content-length"))
        block = data[end + 4:end + 4 + length]
        if len(block) < length:
            raise ValueError(f"record at byte {at} ends early")
        yield headers, block
        at = end + 4 + length
        while data.startswith(b"\r\n", at):
            at += 2


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response records of WARC files (plain or gzip by name), a file a row of its own: files are
    about a gigabyte by custom, and a cluster reads as many at once as it has cores."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                for headers, block in split_records(gzip.decompress(data) if name.endswith(".gz") else data):
                    by_name = {k.lower(): v for k, v in headers}
                    if by_name.get("warc-type") == "response":
                        yield pa.RecordBatch.from_pylist([{
                            "record_id": by_name.get("warc-record-id"), "target_uri": by_name.get("warc-target-uri"),
                            "date": by_name.get("warc-date"), "headers": "\r\n".join(f"{k}: {v}" for k, v in headers),
                            "payload_digest": by_name.get("warc-payload-digest"), "block": block}],
                            pa.schema([("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                                       ("headers", pa.string()), ("payload_digest", pa.string()), ("block", pa.binary())]))
    return files.mapInArrow(read, RESPONSES)
