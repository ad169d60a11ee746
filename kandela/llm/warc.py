"""Derived WARC records: metadata and plain-text conversions that refer to the responses they come from.

A response record is made per page (or given); each gives one ``metadata`` record (application/warc-fields
with the source headers, sizes and digests) and one ``conversion`` record (text/plain). Both name the response in
``WARC-Refers-To``, keep its target URI and date, and carry block and payload digests (sha1, base 32). Record ids
are name-based UUIDs of what a record holds, so a repeated run or a recomputed task gives the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:kandela:warc")
HTTP_HEADERS = (("Content-Type", "text/html; charset=utf-8"),)
TYPES = ("response", "metadata", "conversion")

_OPENING = re.compile(r"<!--|<(script|style|noscript|template|svg)(?=[\s/>]|\Z)", re.I)
_COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")
_TAG_STEP = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')|>""")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in ("script", "style", "noscript", "template", "svg")}
_RAW = ("script", "style")
_BLOCK = re.compile(
    r"</?(?:p|div|br|hr|h[1-6]|li|ul|ol|tr|table|td|th|section|article|header|footer|nav|main|aside|blockquote|pre|form|title|"
    r"figure|figcaption|dl|dt|dd|body|html|head)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?]?[a-zA-Z][^>]*>|<[!?][^>]*>")
_SPACES = re.compile(r"[ \t\r\f\v ]+")
_LINES = re.compile(r" ?\n[ \n]*")


def _tag_end(page: str, at: int) -> int:
    """Where the tag whose name ends at ``at`` ends; a ``>`` in a quoted value does not end it, -1 without an end."""
    for step in _TAG_STEP.finditer(page, at):
        if step[0] == ">":
            return step.end()
    return -1


def without_hidden(page: str) -> str:
    """The page with a blank for every comment and every script, style, noscript, template and svg element.

    Comments, scripts and styles without an end run to the end of the page, as in HTML; of the others only the tag goes
    then, as of ``<svg .../>``. A tag name ends at a blank, ``/`` or ``>``, so custom elements such as ``<svg-icon>`` stay.
    One pass: what was looked for in vain once is not looked for again.
    """
    out, at, unended, quotes = [], 0, set(), True
    while opening := _OPENING.search(page, at):
        out += [page[at:opening.start()], " "]
        if opening[1] is None:
            end = _COMMENT_END.search(page, opening.end())
            at = end.end() if end else len(page)
            continue
        name, at = opening[1].lower(), _tag_end(page, opening.end()) if quotes else -1
        if at < 0:  # no end outside quotes: quotes do not count from here on
            quotes, at = False, page.find(">", opening.end()) + 1 or len(page)
        if name == "svg" and page.endswith("/>", opening.end(), at) or name in unended:
            continue
        end = _ENDS[name].search(page, at)
        if end:
            at = end.end()
        elif name in _RAW:
            at = len(page)
        else:
            unended.add(name)
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """Visible text: scripts, styles and comments go, block elements end lines, entities are resolved once."""
    page = without_hidden(page.replace("\n", " "))
    text = html.unescape(_TAG.sub("", _BLOCK.sub("\n", page)))
    return _LINES.sub("\n", _SPACES.sub(" ", text)).strip()


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(kind: str, *parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ' '.join((kind, *parts)))}>"


def one_line(value: str) -> str:
    """Header values hold no line ends."""
    return re.sub(r"[\r\n]+", " ", value).strip()


def render(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of one record; raises on a wrong length or end."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = [tuple(x.split(": ", 1)) for x in lines]
    length = int(dict(headers)["Content-Length"])
    if first != VERSION or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:length]


def derive(uri: str | None, payload: bytes, date: str = DATE, http_headers: tuple = HTTP_HEADERS) -> list[tuple]:
    """(type, id, refers_to, headers, block) of a response and of the two records derived from it."""
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {one_line(v)}\r\n" for k, v in http_headers) + "\r\n"
    block, payload_digest = head.encode() + payload, digest(payload)
    target = [("WARC-Target-URI", one_line(uri))] if uri is not None else []
    place = [one_line(uri or ""), date, payload_digest]
    response = record_id("response", *place)
    kinds = dict(http_headers).get("Content-Type", "application/octet-stream")

    def made(kind: str, own: str, content_type: str, block: bytes, own_payload: str, refers_to: str | None = None) -> tuple:
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date), *target,
                   *([("WARC-Refers-To", refers_to)] if refers_to else []), ("WARC-Block-Digest", digest(block)),
                   ("WARC-Payload-Digest", own_payload), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
        return kind, own, refers_to, headers, block

    text = plain_text(payload.decode("utf-8", "replace")).encode()
    conversion = record_id("conversion", response, digest(text))
    fields = [("source-record", response), ("source-payload-digest", payload_digest), ("source-payload-length", str(len(payload))),
              ("source-content-type", one_line(kinds)), *[(f"source-header-{k.lower()}", one_line(v)) for k, v in http_headers],
              ("conversion-record", conversion), ("conversion-payload-digest", digest(text)), ("conversion-length", str(len(text)))]
    described = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return [
        made("response", response, "application/http; msgtype=response", block, payload_digest),
        made("metadata", record_id("metadata", response, digest(described)), "application/warc-fields", described,
             digest(described), response),
        made("conversion", conversion, "text/plain; charset=utf-8", text, digest(text), response)]


def derived_records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
                    date_column: str | None = None, types: tuple[str, ...] = TYPES) -> DataFrame:
    """``id, warc_type, record_id, refers_to, target_uri, block_digest, payload_digest, content_length, record``.

    One row per page and type in ``types``; ``record`` is the whole record with its headers. A null page counts as
    empty, a null url leaves the target URI out, a null date becomes the epoch. Repeated pages give
    repeated records with the same ids. Other columns are not read; an empty table gives no rows.
    """
    kind = pages.schema[id_column].dataType
    names = ["warc_type", "record_id", "refers_to", "target_uri", "block_digest", "payload_digest"]
    schema = T.StructType([T.StructField(id_column, kind), *[T.StructField(n, T.StringType()) for n in names],
                           T.StructField("content_length", T.LongType()), T.StructField("record", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part, rows = batch.slice(low, 64), []
                for id_, uri, page, date in zip(*(part.column(c).to_pylist() for c in (id_column, "url", "raw", "date"))):
                    for made, own, refers_to, headers, block in derive(uri, page, date):
                        if made in types:
                            fields = dict(headers)
                            rows.append((id_, made, own, refers_to, fields.get("WARC-Target-URI"), fields["WARC-Block-Digest"],
                                         fields["WARC-Payload-Digest"], len(block), render(headers, block)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [part.column(id_column).type, *[pa.string()] * 6,
                                                                       pa.int64(), pa.binary()])], names=schema.names)

    date = F.coalesce(F.col(date_column).cast("string"), F.lit(DATE)) if date_column else F.lit(DATE)
    return pages.select(id_column, F.col(url_column).cast("string").alias("url"),
                        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("raw"), date.alias("date")).mapInArrow(run, schema)
