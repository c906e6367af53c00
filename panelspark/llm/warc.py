"""WARC archives: records written by Spark's text writer, read back with segment reassembly.

Writing: a record is a row and the blank lines between records are the line separator, so the
archives go to whatever file system Spark writes to. Long blocks are split over continuation
records; HTTP bodies are in chunked framing. Payloads that repeat are written as revisits.

Reading: archives are read as binary files and cut into records by their declared lengths, while
they are unpacked. Records are then grouped by their origin identifier, ordered by segment
number, checked against the declared total length, and their chunked framing is decoded.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import letting_go, saved
from panelspark.session import scratch_dir

#: Bytes of a block in one record, bytes of a chunk of an HTTP body, rows of an archive file.
SEGMENT, CHUNK, FILE_ROWS = 8192, 3000, 2000
#: Bytes from which a repeated payload is written as a revisit.
LEAST_REVISIT = 1000

_GAP = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORDS = "origin string, segment int, total long, kind string, id string, uri string, refers string, digest string, block binary"
_PAYLOADS = (
    "record_id string, record_type string, uri string, refers string, declared string, "
    "payload binary, payload_bytes long, payload_digest string, problem string"
)


def record_id(page_id, digest: str, own: str = "") -> str:
    """Identifier of a page's record: page (empty if null), payload digest, and in records of their
    own a random part, as rows may repeat; references leave it out."""
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}{own and ':'}{own}>"


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Runs of about ``size`` bytes that break no UTF-8 character."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in _cuts(body, size)) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """Body of a chunked message: sizes are hexadecimal, extensions and trailers are ignored."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0].strip(), 16)
        if not size:
            return b"".join(out)
        at = end + 2
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(framed[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", len(block))] if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block


def records(page_id, uri, payload: bytes | None, digest: str, refers, size: int, segment: int) -> Iterator[bytes]:
    """The records of a page: a revisit (headers only) where ``refers`` names the page it repeats."""
    me = record_id(page_id, digest, uuid.uuid4().hex)
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri) if uri else None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", me), ("WARC-Target-URI", uri)]
    fields += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    fields += [("Content-Type", "application/http;msgtype=response")]
    if refers is not None:
        fields[0] = ("WARC-Type", "revisit")
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers, digest))]
        yield _record(fields, head + b"Content-Length: %d\r\n\r\n" % size)
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = list(_cuts(block, segment))
    if len(parts) == 1:
        yield _record(fields, block)
        return
    yield _record([*fields, ("WARC-Segment-Number", 1)], parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{me[:-1]}:{n}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
        more += [("WARC-Segment-Origin-ID", me), ("WARC-Segment-Number", n)]
        if n == len(parts):
            more.append(("WARC-Segment-Total-Length", len(block)))
        yield _record(more, part)


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", html: str = "html",
    segment: int = SEGMENT, least: int = LEAST_REVISIT,
) -> None:
    """Write the pages as gzipped WARC archives into the folder ``path``.

    A null page is an empty payload. Of equal payloads of at least ``least`` bytes the one with the
    largest key is the response and the others revisit it; rows that repeat that key are responses.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    heads = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
    rows = rows.join(heads.filter("n > 1 AND head IS NOT NULL").select("digest", "head"), "digest", "left")
    again = (F.col("bytes") >= least) & F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    rows = rows.select(
        "page_id", "uri", "digest", "bytes",
        F.when(~F.coalesce(again, F.lit(False)), F.col("payload")).alias("payload"),
        F.when(again, F.col("head")).alias("refers"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for page in batch.to_pylist():
                for made in records(
                    page["page_id"], page["uri"], page["payload"], page["digest"], page["refers"], page["bytes"], segment
                ):
                    held.append(made)
                    size += len(made)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    made = rows.mapInArrow(work, "value binary").select(F.col("value").cast("string"))
    writer = made.write.option("lineSep", _GAP).option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
    with letting_go(pages.sparkSession):
        writer.text(path)


def _streamed(content: bytes) -> Iterator[bytes]:
    """An archive's bytes piece by piece, unpacked if it is gzip (of one member or of many)."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    at = 0
    while at < len(content):
        unpack = zlib.decompressobj(31)
        while at < len(content) and not unpack.eof:
            piece = content[at : at + (1 << 16)]
            out = unpack.decompress(piece)
            at += len(piece) - len(unpack.unused_data)
            if out:
                yield out


def parse(content: bytes) -> Iterator[dict]:
    """The records of an archive, cut by their declared lengths."""
    held = bytearray()
    source = _streamed(content)

    def need(n: int) -> bool:
        while len(held) < n:
            piece = next(source, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while need(1) and held[:1] in (b"\r", b"\n"):
            del held[:1]
        if not need(1):
            return
        end = -1
        while (end := held.find(b"\r\n\r\n")) < 0 and need(len(held) + 1):
            pass
        if end < 0 or not held.startswith(b"WARC/"):
            yield {"id": None, "kind": "broken", "block": bytes(held)}
            return
        fields = {}
        for line in bytes(held[:end]).decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        del held[: end + 4]
        size = int(fields.get("content-length", 0))
        need(size)
        block = bytes(held[:size])
        del held[:size]
        me = fields.get("warc-record-id")
        yield {
            "origin": fields.get("warc-segment-origin-id", me),
            "segment": int(fields.get("warc-segment-number", 0)),
            "total": int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
            "kind": fields.get("warc-type"),
            "id": me,
            "uri": fields.get("warc-target-uri"),
            "refers": fields.get("warc-refers-to"),
            "digest": fields.get("warc-payload-digest"),
            "block": block if len(block) == size else None,
        }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in a folder, segments not yet joined."""
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    kinds = {"segment": pa.int32(), "total": pa.int64(), "block": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names
            )

        for files in batches:
            for content in files.column(0):
                rows, size = [], 0
                for row in parse(content.as_py()):
                    rows.append(row)
                    size += len(row["block"] or b"")
                    if size > 1 << 22:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(work, _RECORDS)


def _message(block: bytes) -> tuple[bytes, dict]:
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("an HTTP message without an end of its headers")
    fields = dict(x.lower().split(b": ", 1) for x in head.split(b"\r\n")[1:] if b": " in x)
    return body, fields


def _whole(parts: list[dict], total, kind: str) -> tuple[bytes | None, str | None]:
    """(payload, what is wrong with it)."""
    numbers = [p["segment"] for p in parts]
    if numbers not in ([0], list(range(1, len(parts) + 1))) or (numbers != [0] and total is None):
        return None, "segments are missing or repeated"
    if any(p["block"] is None for p in parts):
        return None, "a record is cut short"
    block = b"".join(p["block"] for p in parts)
    if total is not None and len(block) != total:
        return None, "the segments do not have the declared total length"
    try:
        body, fields = _message(block)
        if kind == "revisit":
            return None, None
        return (unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body), None
    except ValueError as error:
        return None, f"not readable: {error}"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record: its payload joined from all segments, or what is wrong with it.

    Continuations meet their origin by identifier, so a group is one record. A revisit has no
    payload; its digest is the declared one.
    """
    parts = read_records(spark, path).filter("kind IN ('response', 'revisit', 'continuation')")
    part = F.struct("segment", "block", "total", "kind", "uri", "refers", "digest")
    grouped = parts.groupBy("origin").agg(F.collect_list(part).alias("parts"))
    names = [x.split()[0] for x in _PAYLOADS.split(", ")]
    kinds = [pa.string()] * 5 + [pa.binary(), pa.int64(), pa.string(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for origin, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts.sort(key=lambda p: p["segment"])
                head = parts[0]
                total = next((p["total"] for p in parts if p["total"] is not None), None)
                payload, problem = _whole(parts, total, head["kind"])
                digest = hashlib.sha1(payload).hexdigest() if payload is not None else None
                declared = (head["digest"] or "").removeprefix("sha1:") or None
                if digest and declared and digest != declared:
                    problem = "the payload does not have the declared digest"
                size = len(payload) if payload is not None else None
                rows.append(
                    (origin, head["kind"], head["uri"], head["refers"], declared, payload, size, digest, problem)
                )
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return grouped.mapInArrow(work, _PAYLOADS)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    write_warc(pages, path)
    back = saved(read_warc(spark, path).drop("payload", "uri"), "warc-read")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*):", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    sizes = back.filter("record_type = 'response'")
    sizes = sizes.select(F.regexp_replace("record_id", ":[^:]*>$", ">").alias("refers"), "payload_bytes")
    sizes = sizes.groupBy("refers").agg(F.max("payload_bytes").alias("_bytes"))
    back = back.join(sizes, "refers", "left")
    revisit = F.col("record_type") == "revisit"
    return back.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.when(revisit, number("refers")).alias("refers_to"),
        "problem",
    )
