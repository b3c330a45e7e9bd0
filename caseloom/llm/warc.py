"""WARC derivatives: metadata and plain-text conversion records from response records.

Method. Every response becomes a metadata record (application/warc-fields: title, outlinks, the
source's HTTP status and headers, its digests) and a conversion record (text/plain). Both name the
response in WARC-Refers-To, keep its target URI and date in WARC-Refers-To-Target-URI and
WARC-Refers-To-Date, and carry the digests of their own block; a conversion's payload is its block, so its
WARC-Payload-Digest is its own too, and the source's digests and headers are fields of the metadata. Record ids are made from the response's id, so reruns agree and the links hold.

Defined results: null html counts as an empty page; a null url leaves the URI headers out; pages of any length
are converted whole; equal rows give equal records, once for each row; broken or unclosed markup is read to its end; a record whose
length header or HTTP head is missing or wrong raises ValueError when parsed; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: The date of responses built from a table without one.
DATE = "2024-01-01T00:00:00Z"
#: Bytes of pages whose records are held at a time.
SLICE = 8_000_000
VERSION = b"WARC/1.1"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:caseloom:warc")


@dataclass
class Record:
    headers: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)

    def to_bytes(self) -> bytes:
        """With the length of the block as it is; line breaks inside values are folded into spaces."""
        lines = [VERSION]
        lines += [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}".encode() for k, v in self.headers if k.lower() != "content-length"]
        return b"\r\n".join([*lines, f"Content-Length: {len(self.block)}".encode(), b"", self.block]) + b"\r\n\r\n"


def read_records(data: bytes) -> Iterator[Record]:
    """The records of a WARC file, plain or gzipped (one member a record, or one for all)."""
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        yield from read_records(d.decompress(data))
        data = d.unused_data
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC head at byte {at}")
        head = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in head)]
        length = next((v for k, v in headers if k.lower() == "content-length"), "")
        if not length.isdigit() or end + 4 + int(length) > len(data):
            raise ValueError(f"wrong length at byte {at}")
        yield Record(headers, data[end + 4 : end + 4 + int(length)])
        at = end + 4 + int(length)
        while data.startswith(b"\r\n", at):
            at += 2


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join('' if p is None else p + chr(1) for p in parts))}>"


def response(page_id, url: str | None, page: str | None, date: str = DATE) -> Record:
    """A response record for a page: HTTP head and body, with payload and block digests."""
    body = (page or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(body)}\r\n\r\n".encode() + body
    payload = digest(body)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id(None if page_id is None else str(page_id), url, payload))]
    headers += [("WARC-Target-URI", url)] if url is not None else []
    headers += [("WARC-Date", date), ("WARC-Payload-Digest", payload), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")]
    return Record(headers, block)


_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg|title)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul|body|html|head)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"<(?:[a-zA-Z/!?][^>]*)(?:>|\Z)")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_HREF = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_BLANK = re.compile(r"[^\S\n]+")


def plain_text(page: str) -> str:
    """Text of a page: markup, scripts, styles and the title left out, blocks on lines of their own."""
    text = _TAG.sub("", _BREAK.sub("\n", _DROP.sub(" ", page)))
    lines = (line.strip() for line in _BLANK.sub(" ", html.unescape(text).replace("\r", "\n")).split("\n"))
    return "\n".join(line for line in lines if line)


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    head, parted, body = block.partition(b"\r\n\r\n")
    if not parted or not head.startswith(b"HTTP/"):
        raise ValueError("no HTTP head")
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    return status, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)], body


def derive(source: Record) -> tuple[Record, Record]:
    """The metadata and the conversion record of a response."""
    status, http, body = _http(source.block)
    kind = next((v for k, v in http if k.lower() == "content-type"), "")
    charset = re.search(r"charset=[\"']?([\w.-]+)", kind, re.I)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    origin, uri, date = source.get("WARC-Record-ID") or "", source.get("WARC-Target-URI"), source.get("WARC-Date") or DATE
    payload = source.get("WARC-Payload-Digest") or digest(body)
    title = _TITLE.search(page)
    fields = [("source-status", status), *((f"source-header-{k.lower()}", v) for k, v in http), ("source-payload-digest", payload)]
    fields += [("source-block-digest", source.get("WARC-Block-Digest") or digest(source.block))]
    fields += [("title", " ".join(html.unescape(title[1]).split()))] if title else []
    fields += [("outlink", " ".join(html.unescape(next(x for x in m if x) if any(m) else "").split())) for m in _HREF.findall(page)]
    blocks = {"metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")), "conversion": ("text/plain; charset=utf-8", plain_text(page).encode("utf-8", "replace"))}
    out = []
    for name, (content, block) in blocks.items():
        headers = [("WARC-Type", name), ("WARC-Record-ID", record_id(origin, name))]
        headers += [("WARC-Target-URI", uri)] if uri is not None else []
        headers += [("WARC-Date", date), ("WARC-Refers-To", origin)]
        headers += [("WARC-Refers-To-Target-URI", uri)] if uri is not None else []
        headers += [("WARC-Refers-To-Date", date)] + ([("WARC-Payload-Digest", digest(block))] if name == "conversion" else [])
        out.append(Record([*headers, ("WARC-Block-Digest", digest(block)), ("Content-Type", content)], block))
    return out[0], out[1]


SCHEMA = "page_id {kind}, record_type string, record_id string, refers_to string, target_uri string, content_length bigint, block_digest string, source_payload_digest string, record_sha256 string, record binary"


def derivatives(pages: DataFrame) -> DataFrame:
    """Two rows per page, metadata and conversion, with the whole record in ``record``."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2, SLICE)):
            rows: list[tuple] = []
            for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                # Through the written form, as a reader of the response's file would see it.
                (source,) = read_records(response(page_id, url, page).to_bytes())
                for r in derive(source):
                    data = r.to_bytes()
                    rows.append((page_id, r.get("WARC-Type"), r.get("WARC-Record-ID"), r.get("WARC-Refers-To"), r.get("WARC-Target-URI"), len(r.block), r.get("WARC-Block-Digest"), source.get("WARC-Payload-Digest"), hashlib.sha256(data).hexdigest(), data))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), [batch.column(0).type, *[pa.string()] * 4, pa.int64(), *[pa.string()] * 3, pa.binary()])], schema.names)

    text = SCHEMA.format(kind=kind)
    schema = pa.schema([(x.split()[0], pa.null()) for x in text.split(", ")])
    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(build, text)


def to_file(records: list[bytes]) -> bytes:
    """A .warc.gz file of records, one gzip member each, the same bytes in each run."""
    return b"".join(gzip.compress(r, 6, mtime=0) for r in records)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(table(spark, sf_dir, "pages"))
