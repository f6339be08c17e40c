"""WARC archives: write records, read them back, put segments together, undo chunked framing.

Writing. Every page becomes one HTTP response with chunked transfer framing. A block longer than
``segment_bytes`` is split into a first record and continuation records with rising segment numbers; the last
one names the total length. Of pages with equal payloads of at least ``least_bytes`` the one with the smallest
page id is a response, the others become revisit records that name it and keep only the HTTP header with the
payload's length. Spark's text writer joins records with the blank lines that end a record, so archives are
committed like any other table and lie in the shared folder; ``maxRecordsPerFile`` bounds their size.

Reading. Archives are taken as binary files, one file after another inside a task. Unsegmented records are
decoded at once and only digests leave the task. Segments are grouped by their origin record, equal segments
merged, ordered by number and checked: no gap, and the sum of lengths equals the total. Only segments are
shuffled, and a group is never longer than one page.

Edge cases: a null payload counts as empty; a null url leaves the target out; a null page id gives records
without a page number, which come back as null; rows that repeat the smallest page id of equal payloads are
all responses, and rows equal in page id and payload share a record id and come back as often as they were
written; an empty table gives no records. Columns other than the three named are not read. Of archives written
elsewhere, records whose id names no page come back with a null page. A record without a type, a length or an
honest header, one that is cut short or a part of a broken gzip member, and one of another type come back as a row
with ``complete`` false; reading goes on with the next record after a blank line.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.store import shared_path, stored

RECORD_END = "\r\n\r\n"
CHUNK_BYTES = 8192
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:x-page:"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for i in range(0, len(payload), size) if (c := payload[i : i + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload inside chunked framing; ValueError if the framing is damaged."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        size = int(body[at:end].split(b";")[0], 16)
        if size < 0:
            raise ValueError("a chunk size below zero")
        if size == 0:
            return b"".join(out)
        chunk = body[end + 2 : end + 2 + size]
        if len(chunk) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(chunk)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP header")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _page_records(page, url, html, first, segment_bytes: int, date: str) -> Iterator[bytes]:
    payload = (html or "").encode("utf-8", "surrogatepass")
    digest = hashlib.sha256(payload).hexdigest()
    name = lambda p: f"<{PAGE_URN}{'' if p is None else p}:{digest}>"
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    http = "application/http;msgtype=response"
    shared = [("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Target-URI", target)]
    if first is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", name(page)), ("WARC-Refers-To", name(first))]
        yield _record([*fields, ("WARC-Profile", PROFILE), *shared, ("Content-Type", http)], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    number = 1 if len(parts) > 1 else None
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", name(page)), *shared, ("Content-Type", http)]
    yield _record([*fields, ("WARC-Segment-Number", number)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        own = f"<{PAGE_URN}{'' if page is None else page}:{digest}:{k}>"
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", date)]
        total = len(block) if k == len(parts) else None
        extra = [("WARC-Segment-Origin-ID", name(page)), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)]
        yield _record([*fields, *extra], part)


def mark_repeats(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 100
) -> DataFrame:
    """page, target, body and first: the least page id of an equal long payload, null for that page itself."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page"),
        F.col(url).cast("string").alias("target"),
        body.alias("body"),
        F.when(F.octet_length(body) >= least_bytes, F.sha2(body, 256)).alias("digest"),
    )
    repeated = (
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    # A computed key, so that a frequent digest can be split; payloads without one are spread and meet nothing.
    key = F.concat(F.lit("="), "digest")
    loose = F.concat(F.lit("-"), F.xxhash64("page", "target", "body").cast("string"))
    repeated = repeated.select(key.alias("key"), "first")
    return rows.withColumn("key", F.coalesce(key, loose)).join(repeated, "key", "left").select(
        "page", "target", "body", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("first")
    )


def write_archives(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 100,
    segment_bytes: int = 32 * 1024,
    records_per_file: int = 4000,
    date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Write gzipped archives to a new shared folder and return its path."""
    marked = mark_repeats(pages, page_id, url, html, least_bytes)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for r in _page_records(*row, segment_bytes, date):
                    out.append(r)
                    held += len(r)
                if held > 4_000_000:
                    yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])
                    out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])

    path = shared_path(pages.sparkSession, "warc")
    (
        marked.mapInArrow(records, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )
    return path


def _records_in(archive: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Header fields and block (None: damaged) of every record of a gzipped archive, unpacked piece by piece."""
    unpack, view = zlib.decompressobj(31), memoryview(archive)
    held, at, fed, broken = bytearray(), 0, 0, False

    def more() -> bool:
        nonlocal broken, fed, unpack
        if fed >= len(view) and not unpack.unconsumed_tail:
            return False
        try:
            held.extend(unpack.decompress(view[fed : fed + 65536]))
        except zlib.error:  # nothing after this point can be unpacked
            fed, broken = len(view), True
            return False
        fed = min(fed + 65536, len(view))
        if unpack.eof and unpack.unused_data:  # the next gzip member
            fed -= len(unpack.unused_data)
            unpack = zlib.decompressobj(31)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0 and more():
            pass
        if end < 0:
            if broken or held[at:].strip():
                yield {}, None
            return
        lines = held[at:end].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, length = end + 4, fields.get("content-length", "")
        if not lines[0].startswith("WARC/") or not re.fullmatch("[0-9]{1,18}", length):
            yield fields, None
            seen = at
            while (following := held.find(b"\r\n\r\nWARC/", seen)) < 0:
                seen = max(at, len(held) - 8)
                if not more():
                    return
            at = following + 4
            continue
        length = int(length)
        while len(held) < start + length + 4 and more():
            pass
        if len(held) < start + length:
            yield fields, None
            return
        yield fields, bytes(held[start : start + length])
        at = start + length + 4
        if at > 1_000_000:
            del held[:at]
            at = 0


def _page_number(name: str | None) -> int | None:
    found = re.match(f"<{PAGE_URN}(-?[0-9]{{1,19}})(:|>)", name or "")
    return int(found[1]) if found and -(1 << 63) <= int(found[1]) < 1 << 63 else None


PARSED = "page long, record_type string, refers long, origin string, number int, total long, block binary, payload_bytes long, payload_digest string, complete boolean"
PARSED_ARROW = pa.schema(
    [("page", pa.int64()), ("record_type", pa.string()), ("refers", pa.int64()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("complete", pa.bool_())]
)


def _decoded(block: bytes, digest: str | None) -> tuple[int | None, str | None, bool]:
    """Length, SHA-256 and verdict of a block's payload; a digest of an unknown kind is not compared."""
    try:
        payload = payload_of(block)
    except ValueError:
        return None, None, False
    own = hashlib.sha256(payload).hexdigest()
    return len(payload), own, digest is None or not re.fullmatch("[0-9a-f]{64}", digest) or own == digest


def _parsed(fields: dict[str, str], block: bytes | None) -> tuple:
    kind, name, number = fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-segment-number")
    digest = (fields.get("warc-payload-digest") or "").removeprefix("sha256:") or None
    total = fields.get("warc-segment-total-length")
    counted = all(x is None or re.fullmatch("[0-9]{1,9}", x) for x in (number, total))
    if block is None or name is None or not counted or kind not in ("response", "revisit", "continuation") or (kind == "continuation" and not number):
        return _page_number(name), kind, *[None] * 7, False
    if kind == "revisit":
        length = re.search(rb"(?i)content-length: (\d+)", block)
        refers = _page_number(fields.get("warc-refers-to"))
        page = _page_number(name)
        return page, kind, refers, None, None, None, None, int(length[1]) if length else None, digest, length is not None
    origin = fields.get("warc-segment-origin-id") or name
    if number:
        return _page_number(origin), "response", None, origin, int(number), int(total) if total else None, block, None, digest, None
    return _page_number(origin), kind, None, origin, None, None, None, *_decoded(block, digest)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per written page: page, record_type, refers, payload_bytes, payload_digest, complete."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for archive in batch.column(0):
                for fields, block in _records_in(archive.as_buffer().to_pybytes()):
                    rows.append(_parsed(fields, block))
                    held += 200 + len(rows[-1][6] or b"")
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), PARSED_ARROW, strict=True)], schema=PARSED_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), PARSED_ARROW, strict=True)], schema=PARSED_ARROW)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g in batch.to_pylist():
                parts = sorted(g["parts"], key=lambda p: p["number"])
                block = b"".join(p["block"] for p in parts)
                whole = [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and g["total"] == len(block)
                n, digest, right = _decoded(block, g["digest"]) if whole else (None, None, False)
                out.append((g["page"], g["copies"], n, digest, whole and right))
            columns = [pa.array(c) for c in zip(*out, strict=True)] if out else [pa.array([], pa.null())] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            names = ["page", "copies", "payload_bytes", "payload_digest", "complete"]
            yield pa.record_batch([c.cast(t) for c, t in zip(columns, types, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = stored(files.mapInArrow(parse, PARSED), "warc-parsed")
    columns = ["page", "record_type", "refers", "payload_bytes", "payload_digest", "complete"]
    segments = parsed.filter("number is not null").groupBy("origin", "number").agg(
        F.first("block").alias("block"),
        F.first("page").alias("page"),
        F.max("total").alias("total"),
        F.max("payload_digest").alias("digest"),
        F.count("*").alias("n"),
    )
    grouped = segments.groupBy("origin").agg(
        F.first("page").alias("page"),
        F.collect_list(F.struct("number", "block")).alias("parts"),
        F.max("total").alias("total"),
        F.max("digest").alias("digest"),
        F.max(F.when(F.col("number") == 1, F.col("n"))).alias("copies"),
    )
    together = grouped.mapInArrow(
        assemble, "page long, copies long, payload_bytes long, payload_digest string, complete boolean"
    )
    joined = together.select(
        "page",
        F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers"),
        "payload_bytes",
        "payload_digest",
        "complete",
        F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1)))).alias("_copy"),
    ).drop("_copy")
    return parsed.filter("number is null").select(*columns).unionByName(joined)
