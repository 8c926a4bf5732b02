"""WARC archives with segmented records: writing, reading back, segment reassembly.

Writing: every page is one logical record, an HTTP response in chunked transfer framing.  The
page with the smallest id among equal payloads of at least ``min_dedup`` bytes is a ``response``,
the others are ``revisit`` records that refer to it; smaller payloads are all responses.  A
response block longer than ``segment_bytes`` is cut: the first piece is the response record
(``WARC-Segment-Number: 1``), the others are ``continuation`` records that name it in
``WARC-Segment-Origin-ID``; the last also has ``WARC-Segment-Total-Length``.  Spark's text writer
stores records (the two line ends that close a record are its line separator, gzip its codec), so
commits are atomic and any store works.

Reading: each archive file is parsed in a task; whole records are decoded there.  Continuation
records are grouped by origin id, ordered by segment number, and joined; a record is whole when
its numbers are 1..n without gap and its bytes add up to the total length.  Then the chunked
framing is decoded.  Revisits take the payload digest and length they carry.

Scale: the digest group (which may hold a third of all pages) is reduced by a partial aggregate
of (digest, min id); only ids and digests are joined back, never payloads.  The group of an origin
id is one page.  Only segmented records are shuffled on reading.

Defined results: null html is an empty payload; rows that repeat the smallest
page id of a payload are each a response (a page never refers to its own id); a null page id ranks
last and stays null; an empty table gives no archives and no rows; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.session import scratch_path

END = "\r\n\r\n"
CRLF = b"\r\n"
RECORD = "page_id long, uri string, kind string, refers_to long, html string, digest string, n_bytes long"
PARSED = ("kind string, page_id long, record_id string, origin string, number int, total long, "
          "payload_digest string, payload_bytes long, refers_to long, block binary, whole boolean")


def chunk_frame(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing: hex length lines, data, a zero chunk."""
    out = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        out += [b"%x\r\n" % len(part), part, CRLF]
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def chunk_unframe(data: bytes) -> bytes:
    """Payload of chunked framing (chunk extensions and trailers are skipped); raises if cut short."""
    out, at = [], 0
    while True:
        stop = data.index(CRLF, at)
        n = int(data[at:stop].split(b";")[0], 16)
        at = stop + 2
        if n == 0:
            return b"".join(out)
        if data[at + n:at + n + 2] != CRLF:
            raise ValueError("chunk without its end")
        out.append(data[at:at + n])
        at += n + 2


def record_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def header(kind: str, rid: str, fields: dict, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", "WARC-Date: 2024-01-01T00:00:00Z"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def page_records(row: dict, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one page, without the two line ends that close each."""
    uri = (row["uri"] or "").replace("\r", "%0D").replace("\n", "%0A") or None
    base = {"WARC-Target-URI": uri, "WARC-Payload-Digest": "sha256:" + row["digest"], "WARC-Page-ID": row["page_id"],
            "WARC-Payload-Length": row["n_bytes"]}
    if row["kind"] == "revisit":
        block = b"HTTP/1.1 200 OK\r\n\r\n"
        extra = {"WARC-Refers-To-Page": row["refers_to"],
                 "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        return [header("revisit", record_id(), base | extra, block) + block]
    payload = (row["html"] or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunk_frame(payload, chunk_bytes)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out, origin = [], record_id()
    for n, part in enumerate(parts, 1):
        extra = {} if len(parts) == 1 else {"WARC-Segment-Number": n}
        if n > 1:
            extra["WARC-Segment-Origin-ID"] = origin
            if n == len(parts):
                extra["WARC-Segment-Total-Length"] = len(block)
        out.append(header("response" if n == 1 else "continuation", origin if n == 1 else record_id(), (base if n == 1 else {}) | extra, part) + part)
    return out


def classify(pages: DataFrame, min_dedup: int = 100) -> DataFrame:
    """page_id, uri, html, digest, n_bytes, kind, refers_to of every page."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("uri"), F.col("html"),
                     F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
                     F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("n_bytes"))
    first = (p.where(F.col("n_bytes") >= min_dedup).groupBy("digest")
              .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").select("digest", "_first"))
    same = F.col("_first").isNull() | F.col("page_id").eqNullSafe(F.col("_first"))
    return (p.join(first, "digest", "left")
             .withColumn("kind", F.when(same, "response").otherwise("revisit"))
             .withColumn("refers_to", F.when(~same, F.col("_first"))).drop("_first"))


def write(pages: DataFrame, path: str, min_dedup: int = 100, segment_bytes: int = 16 << 10, chunk_bytes: int = 4 << 10) -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives below ``path``."""
    rows = classify(pages, min_dedup).select("page_id", "uri", "kind", "refers_to",
                                             F.when(F.col("kind") == "response", F.col("html")).alias("html"), "digest", "n_bytes")

    @tk.tidy
    def frame(batches):
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                for r in page_records(row, segment_bytes, chunk_bytes):
                    out.append(r)
                    held += len(r)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (rows.mapInArrow(frame, "record binary").select(F.col("record").cast("string").alias("value"))
         .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 10_000).text(path))


def parse(data: bytes) -> list[dict]:
    """Records of one archive, by their own lengths."""
    out, at = [], 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        f = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(f["content-length"])
        block = data[stop + 4:stop + 4 + n]
        if len(block) != n or data[stop + 4 + n:stop + 8 + n] != b"\r\n\r\n":
            raise ValueError("WARC record cut short")
        f["block"] = block
        out.append(f)
        at = stop + 8 + n
    return out


def payload(block: bytes) -> bytes:
    """Body of an HTTP response block, its transfer framing decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    return chunk_unframe(body) if b"transfer-encoding: chunked" in head.lower() else body


def read(spark, path: str) -> DataFrame:
    """page_id, record_type, refers_to, payload (null for revisits), payload_bytes, payload_digest, whole."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
                  .where("length > 0").select("content"))
    num = lambda f, k: int(f[k]) if f.get(k, "None") not in ("None", "null") else None

    @tk.tidy
    def records(batches):
        for batch in batches:
            for data in batch.column(0):
                found = []
                for f in parse(gzip.decompress(data.as_buffer())):
                    kind, rid = f["warc-type"], f["warc-record-id"]
                    number = int(f.get("warc-segment-number", 0))
                    digest, n_bytes, block, whole = f.get("warc-payload-digest", "")[7:], num(f, "warc-payload-length"), f["block"], None
                    if kind == "response" and not number:
                        block, whole = payload(block), True
                        digest, n_bytes = hashlib.sha256(block).hexdigest(), len(block)
                    found.append({"kind": kind, "page_id": num(f, "warc-page-id"), "record_id": rid,
                                  "origin": f.get("warc-segment-origin-id") or (rid if number else None), "number": number,
                                  "total": num(f, "warc-segment-total-length"), "payload_digest": digest, "payload_bytes": n_bytes,
                                  "refers_to": num(f, "warc-refers-to-page"), "block": block, "whole": whole})
                for i in range(0, len(found), 500):
                    yield pa.RecordBatch.from_pylist(found[i:i + 500], SCHEMA)

    every = files.mapInArrow(records, PARSED)
    plain = every.where("origin IS NULL").select("page_id", F.col("kind").alias("record_type"), "refers_to",
                                                 F.when(F.col("kind") == "response", F.col("block")).alias("payload"),
                                                 "payload_bytes", "payload_digest", F.coalesce("whole", F.lit(True)).alias("whole"))
    # one group is one page
    parts = (every.where("origin IS NOT NULL").groupBy("origin")
                  .agg(F.sort_array(F.collect_list(F.struct("number", "block", "total", "page_id"))).alias("parts")))

    @tk.tidy
    def join(batches):
        for batch in batches:
            found = []
            for origin, group in zip(batch.column(0).to_pylist(), batch.column(1)):
                found += joined(group.as_py())
            yield pa.RecordBatch.from_pylist(found, JOINED)

    whole = parts.mapInArrow(join, "page_id long, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, whole boolean")
    return plain.unionByName(whole)


SCHEMA = pa.schema([("kind", pa.string()), ("page_id", pa.int64()), ("record_id", pa.string()), ("origin", pa.string()),
                    ("number", pa.int32()), ("total", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                    ("refers_to", pa.int64()), ("block", pa.binary()), ("whole", pa.bool_())])
JOINED = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("whole", pa.bool_())])


def joined(parts: list[dict]) -> list[dict]:
    """The record of one origin from its segments in order; ``whole`` is false if one is missing."""
    block = b"".join(p["block"] for p in parts)
    whole = [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and parts[-1]["total"] == len(block)
    body = payload(block) if whole else None
    return [{"page_id": parts[0]["page_id"], "record_type": "response", "refers_to": None, "payload": body,
             "payload_bytes": len(body) if whole else None,
             "payload_digest": hashlib.sha256(body).hexdigest() if whole else None, "whole": whole}]


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` under the shared checkpoint folder and read the archives back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)
