"""WARC archives: one gzip member per record, written and read record by record.

Of records with the same payload of at least REVISIT_BYTES bytes, the one with the largest page_id is the response and
the others are revisits of it. Writing tasks make one file each, under a name of their own attempt; the table of
files that succeeded is what is read, so tasks that run again leave at most a file that nothing refers to. Reading
takes 64 KiB at a time through an incremental zlib decompressor, frames records by their Content-Length and checks
both digests.

Defined results: a null html is an empty payload; a null page_id is written as such and never a response to others;
repeated rows of a response are all responses; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, lean, open_fs, staged

REVISIT_BYTES, READ_BYTES, FILE_BYTES = 1000, 1 << 16, 256 << 20
DATE = "2024-01-01T00:00:00Z"
FILES = "path string, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class DamagedArchive(ValueError):
    pass


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha1: str) -> bytes:
    """A record as WARC 1.1; a revisit has the HTTP headers but no payload. X-Payload-Length keeps its length."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    safe = re.sub(r"[\x00-\x20\x7f]", "", url or "")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", safe),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
        ("WARC-Block-Digest", base32_sha1(block)),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[-1:-1] = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", name(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(stream: BinaryIO) -> Iterator[bytes]:
    """The content of each gzip member, reading READ_BYTES at a time."""
    left, z, parts = b"", None, []
    while True:
        if not left:
            left = stream.read(READ_BYTES)
            if not left:
                break
        if z is None:
            z, parts = zlib.decompressobj(31), []
        try:
            parts.append(z.decompress(left))
        except zlib.error as e:
            raise DamagedArchive(str(e)) from e
        left = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(parts)
            z = None
    if z is not None:
        raise DamagedArchive("the last member is cut off")


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(fields, HTTP header, payload) of one record; checks framing and digests."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        raise DamagedArchive("no record starts here")
    fields = {}
    for line in data[:end].decode().split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    size = int(fields["content-length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) != size or data[end + 4 + size :] != b"\r\n\r\n":
        raise DamagedArchive("Content-Length does not frame the block")
    if base32_sha1(block) != fields["warc-block-digest"]:
        raise DamagedArchive("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == "response" and base32_sha1(payload) != fields["warc-payload-digest"]:
        raise DamagedArchive("payload digest differs")
    return fields, http, payload


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, sha1, refers_to (null for responses)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html)
    own = own.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    long = own.filter(F.octet_length("html") >= REVISIT_BYTES)
    last = long.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # narrow rows meet by digest, where one may be hot; whole pages meet by page_id
    narrow = long.select("page_id", "sha1").join(last, "sha1").filter("last is not null").distinct()
    narrow = narrow.select(F.col("page_id").alias("p"), F.col("sha1").alias("s"), "last")
    joined = own.join(narrow, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s")), "left")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("last")), F.col("last"))
    return joined.withColumn("refers_to", refers_to).select("page_id", "url", "html", "sha1", "refers_to")


def write_archives(pages: DataFrame) -> DataFrame:
    """(path, records) of the files written."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = fresh(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, path, size, records, rows = TaskContext.get().partitionId(), None, "", 0, 0, []
        for b in batches:
            for r in b.to_pylist():
                if out is None or size > FILE_BYTES:
                    if out is not None:
                        out.close()
                        rows.append({"path": path, "records": records})
                    path, size, records = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    files, place = open_fs(path)
                    files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = files.open_output_stream(place, compression=None)
                data = member(record(r["page_id"], r["url"], r["html"].encode(), r["refers_to"], r["sha1"]))
                out.write(data)
                size, records = size + len(data), records + 1
        if out is not None:
            out.close()
            rows.append({"path": path, "records": records})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

    return staged(with_revisits(pages).mapInArrow(lean(run), FILES), "warc-files")


def read_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def number(name: str | None) -> int | None:
        digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, place = open_fs(path)
                rows, seen = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for data in members(stream):
                        fields, _, payload = parse(data)
                        size = int(fields["x-payload-length"])
                        if fields["warc-type"] == "response" and size != len(payload):  # a revisit holds no payload
                            raise DamagedArchive("payload length differs")
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        rows.append({"page_id": number(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": number(fields.get("warc-refers-to"))})
                        seen += 1
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows = []
                if seen != records:
                    raise DamagedArchive(f"{path} has {seen} of {records} records")
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return files.repartition(tasks).mapInArrow(lean(run), RECORDS)


def archive(pages: DataFrame) -> DataFrame:
    return read_archives(pages.sparkSession, write_archives(pages))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT d, max(page_id) AS last FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest, CASE WHEN m.last <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN m.last <> p.page_id THEN m.last END AS refers_to FROM p LEFT JOIN m ON m.d = p.d AND p.n >= {REVISIT_BYTES}"""
