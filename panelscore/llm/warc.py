"""WARC archives: writing pages as records, and a salvage reader.

Writing: one record per page, a gzip member each. Of pages with equal payloads (at least ``min_bytes`` long) the
one with the smallest page_id is a response, the others revisit it. Spark's text writer writes the archives, one file per
task and ``PER_FILE`` records at most, with its commit protocol and to any file system Spark can write; the
writer's line separator is set to an empty gzip member, so an archive is a plain run of members.

Reading: every record is checked (gzip CRC, version line, Content-Length, record end, block and payload digests).
After a failed check the reader searches for the next gzip member or version line that starts a valid
record, goes on there, and logs the bytes between as a quarantined gap (offset, length, reason). Plain and
gzip-compressed records may be mixed in an archive. The content of a member is searched in the same way, and so is what
a broken or cut off member gives before its error: its whole records are read. Records and gaps inside a member have the
offset and length of the member's bytes they come from; an inner gap's reason names its place in the content.

Scale: an archive is one row of one task, so its size bounds a task's memory; writing bounds it by ``PER_FILE``.
Equal payloads meet as one digest row per group (pre-aggregated); the join back splits hot digests.

Defined results: further columns may have any name, for inner columns take names that the table does not have; a null html is an empty payload; a null page_id is written without an id and is a response
only if all of its group are null; repeated rows of the smallest page_id are all responses; an empty table
gives no records; line breaks and control characters of a url are percent-encoded.
"""
from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded_batches, table

PER_FILE = 4096
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300" + "00" * 8)
MAGIC, VERSION, VERSION_LINE = b"\x1f\x8b\x08", b"WARC/1.", re.compile(rb"WARC/1\.\d\r\n")
STEP = 1 << 16
TYPES = ("response", "revisit")


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one uncompressed WARC record, its closing line breaks included."""
    uri = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{sha1(payload)}", f"WARC-Block-Digest: sha1:{sha1(block)}", f"Payload-Bytes: {len(payload)}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if uri:
        head.append(f"WARC-Target-URI: {uri}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` under ``path``."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.encode(html, "UTF-8"), F.encode(F.lit(""), "UTF-8")).alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    first = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("same")
             .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "first"))
    marked = (rows.join(first, "same", "left")
              .select("id", "url", "payload", "first", (F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit")))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array([member(record(*r)) for r in zip(*columns)], pa.binary())], ["value"])

    (marked.mapInArrow(members, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("maxRecordsPerFile", PER_FILE).text(path))


def inflate(data: bytes, at: int) -> tuple[bytes, int | None]:
    """The content and end of the gzip member that starts at ``at``; if it is broken or cut off, what came before the error, and None."""
    d, out, p = zlib.decompressobj(31), [], at
    try:
        while not d.eof:
            if p >= len(data):
                return b"".join(out), None
            out.append(d.decompress(data[p:p + STEP]))
            p += STEP
    except zlib.error:
        return b"".join([*out, *(x for _, x in byte_by_byte(data, at, p))]), None
    return b"".join(out), min(p, len(data)) - len(d.unused_data)


def byte_by_byte(data: bytes, at: int, p: int) -> Iterator[tuple[int, bytes]]:
    """(place behind it, what it adds) for each byte from ``p`` to the error of the member that starts at ``at``."""
    d = zlib.decompressobj(31)
    d.decompress(data[at:p])
    try:
        for i in range(p, len(data)):
            yield i + 1, d.decompress(data[i:i + 1])
    except zlib.error:
        return


def used(data: bytes, at: int, length: int) -> int:
    """Up to where the broken member at ``at`` has surely been read when it has given ``length`` bytes."""
    d, p, left = zlib.decompressobj(31), at, length
    try:
        while left > 0:
            part = data[p:p + STEP]
            left -= len(d.decompress(part, left))
            p += len(part) - len(d.unconsumed_tail)
    except zlib.error:
        for p, x in byte_by_byte(data, at, p):
            left -= len(x)
            if left <= 0:
                break
    return max(at + 1, p - 8)  # the decoder may hold some bytes that it has not used


URN = "<urn:page:"


def _whole(value: str) -> int | None:
    """A whole number of at most 64 bits as this library writes it; None for anything else."""
    digits = value.removeprefix("-")
    return int(value) if digits.isascii() and digits.isdecimal() and len(digits) < 20 and -(1 << 63) <= int(value) < 1 << 63 else None


def _urn(value: str | None) -> int | None:
    return _whole(value[len(URN):-1]) if value and value.startswith(URN) and value.endswith(">") else None


def parse(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record that starts at ``at`` (headers, payload) and its end, or the check it fails."""
    if not VERSION_LINE.match(data, at):
        return "no version line"
    body = data.find(b"\r\n\r\n", at)
    if body < 0:
        return "header without end"
    lines = data[at:body].decode("utf-8", "replace").split("\r\n")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if (_whole(head.get("content-length", "")) or -1) < 0 and head.get("content-length") != "0":
        return "no Content-Length"
    for name, value in head.items():
        if name in ("warc-record-id", "warc-refers-to") and value.startswith(URN) and _urn(value) is None:
            return "bad record id"
        if name == "payload-bytes" and _whole(value) is None:
            return "bad Payload-Bytes"
    body += 4
    end = body + int(head["content-length"])
    if end + 4 > len(data):
        return "cut off"
    if data[end:end + 4] != b"\r\n\r\n":
        return "no record end"
    block = data[body:end]
    if "warc-block-digest" in head and head["warc-block-digest"] != f"sha1:{sha1(block)}":
        return "block digest"
    payload = block
    if head.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    if head.get("warc-type") != "revisit" and "warc-payload-digest" in head and head["warc-payload-digest"] != f"sha1:{sha1(payload)}":
        return "payload digest"
    return {"head": head, "payload": payload}, end + 4


def contents(data: bytes) -> tuple[list[tuple[int, dict]], list[tuple[int, int, str]], int]:
    """The valid records of a member's content (end, record), the gaps (begin, end, reason) between them, and the end of the last record."""
    at, last, gap, reason, found, gaps = 0, 0, None, "", [], []
    while at < len(data):
        r = parse(data, at)
        if isinstance(r, str):
            if gap is None:
                gap, reason = at, r
            at = data.find(VERSION, at + 1)
            if at < 0:
                break
            continue
        if gap is not None:
            gaps.append((gap, at, reason))
            gap = None
        at = last = r[1]
        found.append((last, r[0]))
    if gap is not None:
        gaps.append((gap, len(data), reason))
    return found, gaps, last


def salvage(data: bytes) -> Iterator[tuple]:
    """("record", offset, length, head, payload) and ("gap", offset, length, reason), in order, covering every byte."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        found, gaps, end, why = [], [], at, "no version line"
        if data.startswith(MAGIC, at):
            content, whole = inflate(data, at)
            records, gaps, last = contents(content)
            found, why = [r for _, r in records], ""
            if whole is None and not found:
                why = "broken member"
            elif whole is None:
                end = used(data, at, last)
                gaps = [g for g in gaps if g[1] <= last]  # what follows is part of the gap behind ``end``
            elif gaps and not found:
                why = gaps[0][2]
            else:
                end = whole
        else:
            r = parse(data, at)
            if isinstance(r, str):
                why = r
            else:
                found, end, why = [r[0]], r[1], ""
        if not why:
            if gap is not None:
                yield "gap", gap, at - gap, reason, None
                gap = None
            for f in found:
                yield "record", at, end - at, f["head"], f["payload"]
            for begin, stop, inner in gaps:
                yield "gap", at, end - at, f"{inner} (content {begin} to {stop})", None
            at = end
            continue
        if gap is None:
            gap, reason = at, why
        nearest = [p for p in (data.find(MAGIC, at + 1), data.find(VERSION, at + 1)) if p >= 0]
        at = min(nearest, default=len(data))
    if gap is not None:
        yield "gap", gap, len(data) - gap, reason, None


SCHEMA = ("kind string, archive string, offset long, length long, reason string, page_id long, url string, record_type string, "
          "payload_bytes long, payload_digest string, refers_to long, payload binary")




def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows of kind ``record`` (with the payload; null for revisits) and ``gap`` (quarantined bytes) of the archives under ``path``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.strip().split(" ") for f in SCHEMA.split(",")]
        kind = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in names])
        for b in batches:
            for archive, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for what, at, n, head, payload in salvage(data.as_py()):
                    row = dict.fromkeys(kind.names) | {"kind": what, "archive": archive, "offset": at, "length": n}
                    if what == "gap":
                        row["reason"] = head
                    else:
                        revisit = head.get("warc-type") == "revisit"
                        row |= {"page_id": _urn(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "record_type": head.get("warc-type"),
                                "payload_bytes": _whole(head.get("payload-bytes", "")) if revisit else len(payload),
                                "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else sha1(payload),
                                "refers_to": _urn(head.get("warc-refers-to")), "payload": None if revisit else payload}
                    rows.append(row)
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, kind)

    bounded_batches(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "llm-warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return (read_archives(spark, path).where("kind = 'record'")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 40, 5), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, i + 1, 5))::BIGINT >> s) & 31) + 1)::INT, 1)), 'string_agg', '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
