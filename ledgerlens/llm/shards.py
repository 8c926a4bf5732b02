"""Sharded lookups: values of n-gram keys for every document bucket, without a row per occurrence.

Documents are dealt into buckets by their place in their file.  A bucket asks each key shard for
its distinct keys (one packed blob per bucket and shard); a shard sees all buckets' keys, computes
values (for instance corpus counts) and answers each bucket; the answers meet the bucket's texts
again, and every document is scored in one pass.  Both shuffles carry packed distinct keys, so a
word pair that holds a third of all occurrences is one key per bucket, and shards are ranges of a
hash, hence even.

``bucketed`` needs the texts to come from files; other inputs are staged first.  Buckets hold
``BUCKET_ROWS`` rows of up to 64 KB text, fewer rows of longer texts, and a single text over 1 MB.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

BUCKET_ROWS = 2048


def bucketed(docs: DataFrame) -> DataFrame:
    """``docs`` with a long ``_bucket`` that depends only on the row's place in its file."""
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        placed = materialize(docs, "docs").select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = F.when(size <= 64 << 10, BUCKET_ROWS).when(size <= 1 << 20, 64).otherwise(1)
    return (placed.withColumn("_bucket", F.xxhash64("_file", rows, F.floor(F.col("_row") / rows)))
                  .drop("_file", "_row"))


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbouring values."""
    if not len(values):
        return []
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    edges = np.concatenate([[0], cut, [len(values)]])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def bucket_chunks(batches, limit: int = 24 << 20):
    """(bucket, [record batches]) of neighbouring rows of one bucket, near ``limit`` text bytes at most."""
    held, held_bucket, size = [], None, 0
    for batch in batches:
        where = batch.schema.get_field_index("_bucket")
        text = batch.schema.get_field_index("text")
        _, offs = tk.utf8(batch.column(text))
        buckets = batch.column(where).to_numpy(zero_copy_only=False)
        # rows of long texts belong to other buckets than their neighbours: sort within the batch
        order = np.argsort(buckets, kind="stable")
        for a, b in runs(buckets[order]):
            bucket = int(buckets[order[a]])
            part = batch.take(pa.array(order[a:b]))
            n = int((offs[1:] - offs[:-1])[order[a:b]].sum())
            if held and (bucket != held_bucket or size + n > limit):
                yield held_bucket, held
                held, size = [], 0
            held_bucket = bucket
            held.append(part)
            size += n
    if held:
        yield held_bucket, held


def text_of(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of several record batches."""
    return tk.utf8(pa.chunked_array([p.column(p.schema.get_field_index("text")).cast(pa.large_string()) for p in parts]))


# ------------------------------------------------------------------ packed keys
def pack_keys(keys: np.ndarray, low_bytes: int = 6) -> bytes:
    """Sorted distinct uint64 keys: the top 16 bits as group sizes, the rest as 6 bytes each."""
    n = len(keys)
    hi = (keys >> tk.U64(48)).astype(np.int64)
    first, last = (int(hi[0]), int(hi[-1])) if n else (0, -1)
    groups = np.bincount(hi - first, minlength=last - first + 1).astype("<u4") if n else np.zeros(0, "<u4")
    wide = int(groups.max(initial=0)) > 255
    low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low_bytes]
    return (np.array([n, first, len(groups), wide], "<u4").tobytes() + groups.astype("<u4" if wide else "u1").tobytes()
            + np.ascontiguousarray(low).tobytes())


def unpack_keys(blob: bytes) -> np.ndarray:
    n, first, n_groups, wide = np.frombuffer(blob, "<u4", 4).tolist()
    at = 16
    groups = np.frombuffer(blob, "<u4" if wide else "u1", n_groups, at).astype(np.int64)
    at += n_groups * (4 if wide else 1)
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, at).reshape(n, 6)
    keys = out.reshape(-1).view("<u8").astype(tk.U64)
    return keys | (np.repeat(np.arange(first, first + n_groups), groups).astype(tk.U64) << tk.U64(48))


def pack_counts(c: np.ndarray) -> bytes:
    """Counts as one byte each, larger ones in a list of (index, count)."""
    big = np.flatnonzero(c >= 255)
    small = np.minimum(c, 255).astype(np.uint8)
    return (np.array([len(c), len(big)], "<u4").tobytes() + small.tobytes() + big.astype("<u4").tobytes()
            + c[big].astype("<u8").tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    n, n_big = np.frombuffer(blob, "<u4", 2).tolist()
    out = np.frombuffer(blob, np.uint8, n, 8).astype(np.int64)
    if n_big:
        out[np.frombuffer(blob, "<u4", n_big, 8 + n)] = np.frombuffer(blob, "<u8", n_big, 8 + n + 4 * n_big).astype(np.int64)
    return out


def shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard (a range of the top bits; a power of two of them) begins in sorted keys."""
    edges = np.arange(shards, dtype=np.uint64) << tk.U64(64 - (shards.bit_length() - 1))
    return np.append(np.searchsorted(keys, edges), len(keys))


def n_shards(spark) -> int:
    """Shards: the next power of two of the session's shuffle width, 128 at least."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(128, 1 << (width - 1).bit_length())


# ------------------------------------------------------------------ packed texts
def pack_texts(docs: DataFrame, names: list[str]) -> DataFrame:
    """(bucket, shard -1, blob) rows: the named columns and the text of a bucket's rows, compressed."""
    keep = docs.select("_bucket", *names, "text")

    @tk.tidy
    def pack(batches):
        z = zstandard.ZstdCompressor(level=3)
        for bucket, parts in bucket_chunks(batches):
            t = pa.Table.from_batches(parts).combine_chunks().drop_columns("_bucket")
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
            raw = sink.getvalue()
            yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([-1], pa.int32()), pa.array([z.compress(raw)], pa.binary())],
                                             ["bucket", "shard", "blob"])

    return keep.mapInArrow(pack, "bucket long, shard int, blob binary")


def unpack_texts(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()
