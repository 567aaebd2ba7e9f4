"""WARC files and their derivatives: metadata and plain-text conversion records linked to the responses.

Files are gzip members, one per record. A derived record names its response in WARC-Refers-To, repeats its target and
date, and carries the response's digests; the metadata record also holds the title, the links and the HTTP headers.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.llm.base import dealt, texts
from finmart.session import new_folder, written

Header = list[tuple[str, str]]
RECORD = "source_id bigint, record_id string, kind string, target string, refers_to string, head binary, block binary"
_NAMES = ["source_id", "record_id", "kind", "target", "refers_to", "head", "block"]
# Compressed bytes after which a task begins another file.
FILE_BYTES = 256 * 1024 * 1024
_DIGITS = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567" for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]
_HIDDEN = re.compile(r"<(?:(!--)|(script|style|noscript|template)\b|!DOCTYPE)", re.I)
_CLOSE = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "title")}
_BREAK = re.compile(r"<(?:/?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|thead|tbody|section|article|header|footer|nav|"
                    r"aside|main|pre|blockquote|form|title|head|body|html|figure|figcaption|option|select))\b[^>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z][^>]*>")
_TITLE = re.compile(r"<title\b", re.I)
_ANCHOR = re.compile(r"<a\s", re.I)
_HREF = re.compile(r"""href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_ORIGIN = re.compile(r"https?://[a-z0-9.-]+(?=/|$)")
_ROOTED = re.compile(r"(?:/[\w-][\w.,-]*)+/?")
_ABSOLUTE = re.compile(r"https?://[a-z0-9.-]+(?:/[\w-][\w.,-]*)*/?")


class Fields(dict):
    """Values by field name; upper and lower case are one."""

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def __contains__(self, name: str) -> bool:
        return super().__contains__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)


def digest(data: bytes) -> str:
    """SHA-1 in base 32: two of its 32 digits at a time."""
    value = int.from_bytes(hashlib.sha1(data).digest())
    return "sha1:" + "".join([_DIGITS[value >> shift & 1023] for shift in range(150, -1, -10)])


def record_id(*parts: object) -> str:
    """A name that depends on the parts alone: a record made again has the same name."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def one_line(text: str) -> str:
    return " ".join(text.split())


def head_bytes(fields: Header) -> bytes:
    """A record's head; values that come from outside must have been made one line."""
    return b"WARC/1.1\r\n" + "".join([f"{k}: {v}\r\n" for k, v in fields]).encode()


def head_fields(head: bytes) -> Fields:
    """The fields of a record's head, whoever wrote it: any case, blanks around a value or none."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return Fields([(k.lower(), v.strip()) for k, colon, v in [line.partition(":") for line in lines] if colon])


def response(source_id: int | None, url: str | None, page: bytes, date: str) -> tuple[str, bytes, bytes]:
    """(record id, head, block) of a captured page; a missing address gives no target."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page)}\r\n\r\n".encode()
    block, payload = http + page, digest(page)
    name = record_id("response", source_id, url, payload)
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", one_line(date))]
    fields += [("WARC-Target-URI", one_line(url))] if url else []
    fields += [("WARC-Source-ID", str(source_id))] if source_id is not None else []
    fields += [("WARC-Payload-Digest", payload), ("WARC-Block-Digest", digest(block)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return name, head_bytes(fields), block


def shown(page: str) -> str:
    """The page without comments, scripts, styles, templates and the document type.

    What is opened and not closed hides the rest of the page; a tag without its ``>`` is none. One walk over the page.
    """
    kept, at, last = [], 0, page.rfind(">")
    look = 0
    while opened := _HIDDEN.search(page, look):
        look = opened.end()
        if opened[1]:
            end = page.find("-->", look)
            end = len(page) if end < 0 else end + 3
        elif look > last:
            continue
        else:
            end = page.index(">", look) + 1
            if opened[2]:
                closed = _CLOSE[opened[2].lower()].search(page, end)
                end = closed.end() if closed else len(page)
        kept.append(page[at:opened.start()])
        at = look = end
    return "".join([*kept, page[at:]])


def _without_tags(page: str, tag: re.Pattern, by: str) -> str:
    """The page with ``by`` for each tag. No tag ends behind the last ``>``, so none is looked for there."""
    last = page.rfind(">") + 1
    return tag.sub(by, page[:last]) + page[last:]


def plain_text(page: str) -> str:
    """Visible text of a page without hidden parts: a line per block element, blanks in a line joined, no empty lines."""
    text = _without_tags(_without_tags(page, _BREAK, "\n"), _TAG, "")
    lines = [line.split() for line in html.unescape(text).splitlines()]
    return "\n".join([" ".join(words) for words in lines if words])


def page_title(page: str) -> str | None:
    opened = _TITLE.search(page)
    start = page.find(">", opened.end()) + 1 if opened else 0
    closed = _CLOSE["title"].search(page, start) if start else None
    return one_line(html.unescape(page[start:closed.start()])) if closed else None


def _addresses(page: str) -> Iterator[str]:
    """What the first ``href`` of each anchor names; the ends of tags and the next ``href`` are looked for once each."""
    look, end, href = 0, -1, None
    while anchor := _ANCHOR.search(page, look):
        look = anchor.end()
        if end < look:
            end = page.find(">", look)
            end = len(page) if end < 0 else end
        if href is None or href.start() < look:
            href = _HREF.search(page, look)
            if href is None:
                return
        if href.start() < end:
            yield href[1] or href[2] or href[3] or ""
            look = href.end()


def links(page: str, base: str) -> list[str]:
    """Distinct addresses that the anchors of a page without hidden parts point to, in order, absolute where possible."""
    found = []
    origin = _ORIGIN.match(base)
    for raw in dict.fromkeys(_addresses(page)):
        target = one_line(html.unescape(raw))
        if origin and _ROOTED.fullmatch(target):  # what joining gives for a path without dots that begin a part
            target = origin[0] + target
        elif not (origin and _ABSOLUTE.fullmatch(target)):
            try:
                target = urljoin(base, target)
            except ValueError:
                pass
        found.append(target)
    return list(dict.fromkeys(t for t in found if t))


def derived(source: Fields, block: bytes) -> list[tuple[str, str, bytes, bytes]]:
    """(kind, record id, head, block) of the metadata and the conversion record of a response."""
    http, _, payload = block.partition(b"\r\n\r\n")
    page = payload.decode("utf-8", "replace")
    visible = shown(page)
    name, target = source["WARC-Record-ID"], source.get("WARC-Target-URI", "")
    title = page_title(page)
    lines = [] if title is None else [f"title: {title}"]
    lines += [f"http-{line}" for line in http.decode("utf-8", "replace").split("\r\n") if line]
    lines += [f"outlink: {link}" for link in links(visible, target)]
    out = []
    for kind, kind_type, body in (("metadata", "application/warc-fields", "\r\n".join([*lines, ""]).encode()),
                                  ("conversion", "text/plain; charset=utf-8", plain_text(visible).encode())):
        own = record_id(kind, name)
        fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", name), ("WARC-Date", source["WARC-Date"])]
        for key in ("WARC-Target-URI", "WARC-Source-ID"):
            fields += [(key, source[key])] if key in source else []
        fields += [("WARC-Refers-To-Date", source["WARC-Date"])]
        fields += [("WARC-Refers-To-Target-URI", target)] if target else []
        fields += [(f"WARC-Source-{key}-Digest", source[f"WARC-{key}-Digest"]) for key in ("Payload", "Block")
                   if f"WARC-{key}-Digest" in source]
        fields += [("WARC-Block-Digest", digest(body)), ("Content-Type", kind_type), ("Content-Length", str(len(body)))]
        out.append((kind, own, head_bytes(fields), body))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    kinds = [pa.int64(), *[pa.string()] * 4, pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=_NAMES)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of captured pages; a NULL page is an empty one, rows that are alike get the same record id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for source_id, url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch, "html")):
                name, head, block = response(source_id, url, page or b"", date)
                rows.append((source_id, name, "response", url, None, head, block))
            yield _batch(rows)
    slim = pages.select(F.col(f"`{id_col}`").cast("long").alias("source_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html"))
    return slim.mapInArrow(run, RECORD)


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records; records of other kinds give none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for source_id, head, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                fields = head_fields(head)
                for kind, name, own, body in derived(fields, block):
                    rows.append((source_id, name, kind, fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], own, body))
            yield _batch(rows)
    return records.where("kind = 'response'").select("source_id", "head", "block").mapInArrow(run, RECORD)


def write_warc(records: DataFrame, folder: str | None = None, level: int = 1, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """(folder, files): one or more files per task. A file carries the attempt that wrote it, so a task that runs again
    meets no file of its own; ``files`` names those of the attempts that counted, and only they are read.

    The folder must be reachable by every executor and by pyarrow. No record is moved between tasks.
    """
    folder = folder or new_folder(records.sparkSession, "warc")
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(folder)
        made, out = [], None

        for batch in batches:
            heads, blocks = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("head", "block"))
            for head, block in zip(heads, blocks):
                if out is None:
                    made.append([f"part-{context.partitionId():06d}-{len(made):04d}-{context.taskAttemptId()}.warc.gz", 0, 0])
                    out = fs.open_output_stream(f"{base}/{made[-1][0]}", compression=None)
                press = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = press.compress(b"".join([head, b"\r\n", block, b"\r\n\r\n"])) + press.flush()
                out.write(member)
                made[-1][1] += 1
                made[-1][2] += len(member)
                if made[-1][2] >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        columns = list(zip(*made)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["file", "records", "bytes"])

    return folder, written(records.select("head", "block").mapInArrow(run, "file string, records bigint, bytes bigint"), "warc-files")


def members(file, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of an open file, one at a time."""
    left = b""
    while left or (left := file.read(chunk)):
        plain, parts = zlib.decompressobj(31), []
        while not plain.eof:
            parts.append(plain.decompress(left))
            left = plain.unused_data
            if not plain.eof and not (left := file.read(chunk)):
                raise ValueError("the file ends inside a record")
        yield b"".join(parts)


def parsed(member: bytes) -> tuple:
    """A row of RECORD from a member's bytes; the block must have the declared length and digest."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = head_fields(head + b"\r\n")
    block = rest[:int(fields["Content-Length"])]
    told = fields.get("WARC-Block-Digest")
    if rest[len(block):] != b"\r\n\r\n" or (told and told != digest(block)):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is damaged")
    source = fields.get("WARC-Source-ID")
    return (None if source is None else int(source), fields["WARC-Record-ID"], fields["WARC-Type"],
            fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To"), head + b"\r\n", block)


def read_warc(folder: str, files: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """The records of the named files of a folder; a damaged record stops the job with its id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as file:
                    for member in members(file):
                        rows.append(parsed(member))
                        size += len(member)
                        if size >= batch_bytes:
                            yield _batch(rows)
                            rows, size = [], 0
                yield _batch(rows)
    return dealt(files.select("file"), "file").mapInArrow(run, RECORD)


def report(records: DataFrame) -> DataFrame:
    """One row per record: identifiers, kind, and what its head and block say."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for source_id, name, kind, target, refers_to, head, block in zip(*(c.to_pylist() for c in batch.columns)):
                fields = head_fields(head)
                lines = block.decode().split("\r\n") if kind == "metadata" else []
                title = next((x[7:] for x in lines if x.startswith("title: ")), None)
                rows.append((source_id, kind, name, refers_to, target, fields["WARC-Date"], fields.get("WARC-Source-Payload-Digest"),
                             fields["WARC-Block-Digest"], len(block), title, sum(x.startswith("outlink: ") for x in lines)))
            columns = list(zip(*rows)) or [()] * 11
            kinds = [pa.int64(), *[pa.string()] * 7, pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=_REPORT)
    return records.mapInArrow(run, ", ".join(f"{n} {'bigint' if n in ('page_id', 'content_length', 'n_links') else 'string'}" for n in _REPORT))


_REPORT = ["page_id", "kind", "record_id", "refers_to", "target_uri", "record_date", "source_payload_digest", "block_digest",
           "content_length", "title", "n_links"]
