"""Operator 7: WARC derivative builder.

A response record becomes two linked records: `metadata` (what was captured: the
source record's id, type, date, digests and HTTP headers, one `name: value` line
each) and `conversion` (the page's plain text).  Both carry the source's target
URI and date, refer to it by WARC-Refers-To, and are tied to each other by
WARC-Concurrent-To; the source's payload digest is kept as
WARC-Source-Payload-Digest (metadata, conversion).  Record ids are name-based
(from the source's id and the kind), so reruns agree.

Plain text: comments, script, style, noscript, template, svg and head go; block
elements end a line; other tags vanish; character references are resolved; white
space is collapsed within lines and empty lines are dropped.  As in HTML, a head
ends before the first thing that can't be in it, and an unclosed comment, script
or style takes the rest of the page.  Of a noscript, template or svg that is
self-closed or never closed only the tag goes.

Each record is built where its source lies; there is no shuffle.  `read_records`
reads WARC files (plain or gzip), `write_warc` writes them; a file is read in one
task, as a compressed one can't be split.  There it is held as it is stored, and
unpacked record by record.

Headers keep their order and may repeat; in a value, lines that go on are joined
by a space.  Names are matched without case.  Optional headers that a response
lacks: the payload digest is computed, the target URI is empty, the date is the
epoch; without a record id, the id is named by the record's bytes.

Defined cases: a NULL URL is an empty target URI; a NULL body is an empty
payload; a NULL date is the epoch; repeated rows give records of equal ids; very
long pages are converted whole; other columns are ignored.  Records other than
responses, and NULLs, have no derivatives.  A record cut short, or one that is no
WARC record, is an error.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "1970-01-01T00:00:00Z"
BATCH_BYTES = 1 << 24
#: Bytes of a file that are unpacked at a time.
PIECE = 1 << 20
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")
#: tags that decide what is text
_MARK = re.compile(r"<!--|<(/?)(script|style|noscript|template|svg|head|title)(?=[\s/>])[^>]*>", re.I)
#: what may lie between those in a head: space, void elements, declarations, end tags that don't end it
_IN_HEAD = re.compile(r"(?:\s++|<(?:meta|link|base|basefont|bgsound|html)(?=[\s/>])[^>]*>|<(?:!(?!--)|\?)[^>]*>|</(?!(?:head|body|html|br|svg|template)(?=[\s/>]))[A-Za-z][^>]*>)*+", re.I)
_EMPTY_COMMENT = re.compile(r"-?>")
_COMMENT_END = re.compile(r"--!?>")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in ("script", "style", "title")}
_NOSCRIPT = re.compile(r"<(/?)noscript(?=[\s/>])[^>]*>", re.I)
_HEAD_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_BLOCK = re.compile(r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|thead|tbody|section|article|header|footer|nav|aside|main|h[1-6]|blockquote|pre|form|figure|title)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z!?][^>]*>")
_BLANK = re.compile(r"[ \t\r\f\v ]+")


def _shown(page: str) -> str:
    """The page without comments and elements that show no text, each replaced by a space; one pass."""
    out: list[str] = []
    opened: list[tuple[str, int, bool]] = []  # template and svg that wait for their end: name, pieces before, in head
    waiting = {"template": 0, "svg": 0}
    at, in_head, titles = 0, False, True
    while True:
        if in_head:
            at = _IN_HEAD.match(page, at).end()
            m = _MARK.match(page, at)
            if not m or (m[2] or "").lower() == "svg":
                in_head = False  # text or an element of the body: the end tag was left out
                continue
        elif not (m := _MARK.search(page, at)):
            break
        out.append(page[at : m.start()])
        at, name, end = m.end(), (m[2] or "").lower(), m[1] == "/"
        empty = m[0].endswith("/>")
        stop = None
        if not name:
            short = _EMPTY_COMMENT.match(page, at)
            stop = short or _COMMENT_END.search(page, at)
            at = stop.end() if stop else len(page)
        elif name in waiting and end and waiting[name]:
            while True:
                last, pieces, head = opened.pop()
                waiting[last] -= 1
                if last == name:
                    break
            del out[pieces:]
            in_head = head
        elif end and name == "head" and in_head:
            in_head = False
        elif end:
            out.append(m[0])
            continue
        elif name in ("script", "style"):
            if not (empty and waiting["svg"]):  # elsewhere the slash means nothing
                stop = _ENDS[name].search(page, at)
                at = stop.end() if stop else len(page)
        elif name == "noscript":
            stop = None if empty else _NOSCRIPT.search(page, at)
            if stop and stop[1]:
                at = stop.end()
        elif name in waiting:
            if not empty:
                opened.append((name, len(out), in_head))
                waiting[name] += 1
                in_head = False
        elif name == "head":
            in_head = True
        elif in_head:
            stop = _ENDS[name].search(page, at) if titles else None
            titles = bool(stop)
            if stop:
                at = stop.end()
            else:
                in_head = False
        else:
            out.append(m[0])
            continue
        out.append(" ")
    out.append(page[at:])
    return "".join(out)


def plain_text(page: str) -> str:
    body = _shown(page)
    body = _TAG.sub("", _BLOCK.sub("\n", body))
    lines = (_BLANK.sub(" ", x).strip() for x in html.unescape(body).split("\n"))
    return "\n".join(x for x in lines if x)


def title_of(page: str) -> str:
    m = _HEAD_TITLE.search(page)
    return " ".join(html.unescape(_TAG.sub("", m[1])).split()) if m else ""


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; line feeds in header values are folded to spaces."""
    lines = [f"WARC-Type: {kind}", *(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in headers), f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def _headers(head: bytes) -> list[tuple[str, str]]:
    """Headers in order, of a record's bytes before its block."""
    version, _, lines = head.decode("utf-8", "replace").partition("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers: list[tuple[str, str]] = []
    for line in lines.split("\r\n") if lines else []:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        else:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return headers


def _next_record(data: bytes, at: int) -> tuple[list[tuple[str, str]], int, int]:
    """(headers in order, first and end byte of the block) of the record at `at`."""
    stop = data.find(b"\r\n\r\n", at)
    headers = _headers(data[at : stop if stop >= 0 else at])
    size = int(header(headers, "Content-Length") or 0)
    if stop + 4 + size > len(data):
        raise ValueError("the WARC record is cut short")
    return headers, stop + 4, stop + 4 + size


def header(headers: list[tuple[str, str]], name: str) -> str | None:
    """The first value of a header, or None."""
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def parse_record(data: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """(headers, block) of one record."""
    headers, a, b = _next_record(data, 0)
    if data[b:].strip(b"\r\n"):
        raise ValueError("more than one WARC record")
    return headers, data[a:b]


def unpacked(data: bytes) -> Iterator[bytes]:
    """A file's bytes in pieces of at most PIECE; gzip members, one or many, are unpacked as they come."""
    whole = memoryview(data)
    if data[:2] != b"\x1f\x8b":
        yield from (bytes(whole[a : a + PIECE]) for a in range(0, len(data), PIECE))
        return
    at = 0
    while at < len(whole):
        member, rest = zlib.decompressobj(31), b""
        while not member.eof:
            if not rest and at < len(whole):
                rest, at = bytes(whole[at : at + PIECE]), at + PIECE
            piece = member.decompress(rest, PIECE)
            if piece:
                yield piece
            elif not member.unconsumed_tail and at >= len(whole) and not member.eof:
                raise ValueError("the gzip file is cut short")
            rest = member.unconsumed_tail
        at = min(at, len(whole)) - len(member.unused_data)
        while at < len(whole) and whole[at] == 0:  # padding
            at += 1


def split_records(data: bytes) -> Iterator[bytes]:
    """The records of a file's bytes; what is held is the file as it is stored, and a record at a time."""
    pieces, held, done = unpacked(data), bytearray(), False

    def more() -> bool:
        nonlocal done
        piece = next(pieces, None)
        done = done or piece is None
        held.extend(piece or b"")
        return piece is not None

    while True:
        while not done and len(held) < 2 or held[:2] == b"\r\n":
            if held[:2] == b"\r\n":
                del held[:2]
            else:
                more()
        if not held:
            return
        seen = 0
        while (stop := held.find(b"\r\n\r\n", seen)) < 0 and (seen := max(0, len(held) - 3), more())[1]:
            pass
        if stop >= 0:  # the block's end is known
            size = int(header(_headers(bytes(held[:stop])), "Content-Length") or 0)
            while len(held) < stop + 4 + size and more():
                pass
        _, _, end = _next_record(bytes(held), 0) if stop < 0 else (None, None, stop + 4 + size)
        if end > len(held):
            raise ValueError("the WARC record is cut short")
        yield bytes(held[:end]) + b"\r\n\r\n"
        del held[:end]


def response_record(url: str, date: str, page: bytes, key: str) -> tuple[str, bytes]:
    """(record id, record) of an HTTP response that holds the page."""
    rid = f"<urn:uuid:{uuid.uuid5(SPACE, 'response ' + key)}>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(page)).encode() + b"\r\n\r\n" + page
    headers = [("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(page))]
    return rid, record("response", headers, block)


def derive(source: bytes) -> tuple[str, list[tuple[str, str, bytes]]]:
    """(record id of a response record, its derivatives: (kind, record id, record) of metadata and conversion)."""
    headers, block = parse_record(source)
    head, _, payload = block.partition(b"\r\n\r\n")
    page = payload.decode("utf-8", "replace")
    rid = header(headers, "WARC-Record-ID") or f"<urn:uuid:{uuid.uuid5(SPACE, digest(source))}>"
    uri, date = header(headers, "WARC-Target-URI") or "", header(headers, "WARC-Date") or EPOCH
    mid, cid = (f"<urn:uuid:{uuid.uuid5(SPACE, kind + ' ' + rid)}>" for kind in ("metadata", "conversion"))
    of = header(headers, "WARC-Payload-Digest") or digest(payload)
    kept = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", rid), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Source-Payload-Digest", of)]
    text = plain_text(page).encode("utf-8", "replace")
    fields = [("title", title_of(page)), ("text-characters", str(len(text.decode())))]
    fields += [("source-" + k, v) for k, v in headers]
    fields += [("http-" + k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])]
    about = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    meta = record("metadata", [("WARC-Record-ID", mid), *kept, ("WARC-Concurrent-To", cid), ("Content-Type", "application/warc-fields")], about)
    conv = record("conversion", [("WARC-Record-ID", cid), *kept, ("WARC-Concurrent-To", mid), ("Content-Type", "text/plain; charset=utf-8")], text)
    return rid, [("metadata", mid, meta), ("conversion", cid, conv)]


def _responses(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, records = [], []
        for key, url, date, page in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            rid, rec = response_record(url or "", date or EPOCH, (page or "").encode(), f"{key} {url}")
            ids.append(rid)
            records.append(rec)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.string()), pa.array(records, pa.binary())], names=["page_id", "record_id", "record"])


def build_responses(pages: DataFrame) -> DataFrame:
    """page_id, record_id, record of a response for every row (page_id, url, date as text, html)."""
    return pages.select("page_id", "url", "date", "html").mapInArrow(_responses, "page_id long, record_id string, record binary")


def _derivatives(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for key, rec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if rec is None or header(_next_record(rec, 0)[0], "WARC-Type") != "response":
                continue
            of, made = derive(rec)
            for kind, rid, data in made:
                for col, v in zip(out, (key, kind, rid, of, header(_next_record(data, 0)[0], "WARC-Block-Digest"), data), strict=True):
                    col.append(v)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["page_id", "kind", "record_id", "refers_to", "block_digest", "record"])


def build_derivatives(responses: DataFrame) -> DataFrame:
    """page_id, kind, record_id, refers_to, block_digest, record: two rows for each response record."""
    return responses.select("page_id", "record").mapInArrow(_derivatives, "page_id long, kind string, record_id string, refers_to string, block_digest string, record binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, at (number in the file), kind, record_id, record of every record in the WARC files under `path`."""

    names = ["file", "at", "kind", "record_id", "record"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1), strict=True):
                rows: list[tuple] = []
                size = 0
                for n, rec in enumerate(split_records(data.as_py())):
                    headers = _next_record(rec, 0)[0]
                    rows.append((file.as_py(), n, header(headers, "WARC-Type"), header(headers, "WARC-Record-ID"), rec))
                    size += len(rec)
                    if size > BATCH_BYTES:
                        yield pack(rows)
                        rows, size = [], 0
                if rows:
                    yield pack(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, at long, kind string, record_id string, record binary")


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Writes the `record` column as WARC files, one per partition, with Spark's text writer: a record ends in a line
    feed, which the writer adds back.  NULLs are left out."""
    line = F.expr("substring(record, 1, octet_length(record) - 1)").cast("string")  # the bytes pass unchanged
    records.where("record IS NOT NULL").select(line.alias("value")).write.option("compression", compression).text(path)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7, F.lit(360)).cast("int"))
    made = build_derivatives(build_responses(pages.withColumn("date", F.concat(day.cast("string"), F.lit("T00:00:00Z")))))
    return made.select("page_id", "kind", "record_id", "refers_to", "block_digest", F.length("record").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("record_sha256"))
