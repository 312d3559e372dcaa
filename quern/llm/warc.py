"""WARC archives with an index: records are written with their offsets, then read back by coalesced byte ranges.

Writing: each task writes gzip members, one a record, into archives of about ARCHIVE_BYTES in the shared folder, and gives
an index row (file, offset, length, URL, digest) for each. File names hold the task attempt, so a repeated task never
touches a file that the index names. The index is written as a table before anything is read.

Reading: the selected index rows are sorted by file and offset; neighbouring ranges with small gaps become one read of at
most RANGE_BYTES, whatever the number of records in it. Payload digests are computed again and held against the index.

Records with equal payloads of at least min_bytes bytes: the one with the smallest page_id is a response, the others are
revisits that refer to it and hold only its HTTP header. Cases: null html is an empty payload, a null url gives no target
header; rows with a null page_id are responses and are referred to by none; rows that repeat the smallest page_id are all
responses, and rows that repeat a page_id get record ids that tell them apart. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import drop, shared_dir, table, text_chunks, written

ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
#: Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_INDEX_DDL = "page_id long, url string, file string, offset long, length long, digest string, record_type string, refers_to long"
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _packed(record: bytes) -> bytes:
    z = zlib.compressobj(1, wbits=31)
    return z.compress(record) + z.flush()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, again: bool = False) -> tuple[bytes, str]:
    """A whole WARC record, and its payload's digest; `again` says that other rows have the page_id too."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = uuid.uuid4() if page_id is None else f"{page_id}:{uuid.uuid4()}" if again else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parsed(whole: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, payload length by the HTTP header, and payload (empty in a revisit) of a record."""
    head, rest = whole.split(b"\r\n\r\n", 1)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return headers, int(re.search(rb"Content-Length: (\d+)", http)[1]), payload


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder named as Hadoop names it."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", folder))


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        at = TaskContext.get()
        out, name, offset, n = None, "", 0, 0
        for batch in text_chunks(batches, column=2):
            rows = []
            for page, url, html, refers, again in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if out is None:
                    name, offset = f"{at.partitionId():06d}-{at.taskAttemptId()}-{n:04d}.warc.gz", 0
                    out, n = store.open_output_stream(f"{path}/{name}", compression=None), n + 1
                whole, digest = record(page, url, (html or "").encode(), refers, bool(again))
                packed = _packed(whole)
                out.write(packed)
                rows.append((page, url, name, offset, len(packed), digest, "response" if refers is None else "revisit", refers))
                offset += len(packed)
                if offset >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _INDEX, strict=True)], schema=_INDEX)
        if out is not None:
            out.close()

    return run


def ranges(offset: np.ndarray, length: np.ndarray, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> list[tuple[int, int]]:
    """Sorted records as slices [a, b) that one read each covers."""
    out, a = [], 0
    for k in range(1, len(offset) + 1):
        if k == len(offset) or offset[k] > offset[k - 1] + length[k - 1] + gap or offset[k] + length[k] - offset[a] > most:
            out.append((a, k))
            a = k
    return out


def _read(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            files = batch.column(2).to_pylist()
            offset, length, digest, page = (batch.column(k).to_numpy(zero_copy_only=False) if k in (3, 4) else batch.column(k).to_pylist() for k in (3, 4, 5, 0))
            cuts = [0, *(k for k in range(1, len(files)) if files[k] != files[k - 1]), len(files)]
            for first, last in zip(cuts, cuts[1:], strict=False):
                with store.open_input_file(f"{path}/{files[first]}") as f:
                    for a, b in ranges(offset[first:last], length[first:last]):
                        a, b = a + first, b + first
                        data = f.read_at(int(offset[b - 1] + length[b - 1] - offset[a]), int(offset[a]))
                        rows = []
                        for k in range(a, b):
                            at = int(offset[k] - offset[a])
                            headers, size, payload = parsed(zlib.decompress(data[at : at + int(length[k])], 31))
                            kind, refers = headers["WARC-Type"], headers.get("WARC-Refers-To")
                            found = digest_of(payload) if kind == "response" else headers["WARC-Payload-Digest"].removeprefix("sha1:")
                            if found != digest[k] or kind == "response" and size != len(payload):
                                raise ValueError(f"{files[k]}, offset {offset[k]}: the record differs from the index")
                            rows.append((page[k], headers.get("WARC-Target-URI"), size, found, kind, refers and int(refers[len("<urn:page:") : -1]), payload if payloads else None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes one record for each row into `folder`; returns the index, itself written as a table."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("d", F.unhex(F.sha1("html")))
    keyed = pages.where("page_id is not null").groupBy("page_id", "d").agg(F.count("*").alias("rows"), F.max(F.octet_length("html")).alias("size"))
    facts = written(keyed, "digests")
    first = facts.where(F.col("size") >= min_bytes).groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    often = facts.groupBy("page_id").agg(F.sum("rows").alias("n")).where("n > 1").select(F.col("page_id").alias("o"))
    known = facts.join(first, "d", "left").join(often, F.col("page_id") == F.col("o"), "left").where("page_id > first OR o IS NOT NULL")
    known = known.select(F.col("page_id").alias("p"), F.col("d").alias("q"), F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to"), F.col("o").isNotNull().alias("again"))
    marked = pages.join(known, (F.col("page_id") == F.col("p")) & (F.col("d") == F.col("q")), "left")
    index = written(marked.select("page_id", "url", "html", "refers_to", "again").mapInArrow(_write(folder), _INDEX_DDL), "index")
    drop(facts)
    return index


def read_archives(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    rows = selected.select(*_INDEX.names).repartition("file").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(_read(folder, payloads), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/quern-warc-{uuid.uuid4().hex}"
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(index, folder, payloads=False).drop("url", "payload")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(d, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""
