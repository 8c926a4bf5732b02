"""Reads of parts of files: byte prefixes, and quoted CSV split inside a file.

``FilePrefix`` is a Python data source that reads the first n bytes of every file below a folder, one partition per group
of files: files x n bytes are read, whatever the files hold.

``read_quoted_csv`` splits files whose quoted fields hold line breaks.  A byte range cannot know whether it begins
inside quotes, so a first pass has every range report the parity of its quotes and its first record start for both
cases; a running sum of the parities per file (one row per range) picks the right one; a second pass has every range
read from its first record to the next range's.  Records are parsed by Spark's own CSV expression, so types
and NULLs are those of the one-task reader.  Quotes must follow the usual rule: a field with quotes is quoted, and quotes
in it are doubled.

Tasks open files through Arrow's file systems (local, HDFS, S3, GCS); folders are listed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from ledgerlens.session import materialize

MAX_TASKS = 100_000
_LEAST_TASKS, _TASK = 64, 32 << 20  # with more ranges than that many, a task reads ranges of so many bytes
_OUT = 16 << 20  # bytes of records sent to the JVM at once
_PARTITION_VALUE = r"=([^/]+)/[^/]*$"
_FILE_NAME = r"([^/]+)$"


def _open(uri: str):
    """(file system, path) of a file's address as Spark writes it."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file://"):
        from urllib.parse import unquote
        return fs.LocalFileSystem(), unquote(uri[7:])
    return fs.FileSystem.from_uri(uri)


def _read(uri: str, start: int, n: int) -> bytes:
    system, path = _open(uri)
    with system.open_input_file(path) as f:
        return f.read_at(n, start)


# ------------------------------------------------------------------ prefixes
class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class _PrefixReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.n = options["path"], int(options.get("bytes", 1 << 16))
        self.group = int(options.get("filesPerTask", 64))

    def partitions(self):
        from pyarrow import fs
        system, path = _open(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            found = [info]
        else:
            found = [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File]
        hidden = lambda p: any(x[:1] in ("_", ".") and "=" not in x for x in p[len(path.rstrip("/")):].split("/") if x)
        files = sorted((f.path, f.size) for f in found if f is info or not hidden(f.path))
        return [_Files(files[i:i + self.group]) for i in range(0, len(files), self.group)] or [_Files([])]

    def read(self, partition):
        system, _ = _open(self.path)
        for path, size in partition.files:
            with system.open_input_file(path) as f:
                content = f.read_at(min(self.n, size), 0) if size else b""
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([content], pa.binary())], ["path", "length", "content"])


class FilePrefix(DataSource):
    """``spark.read.format("file_prefix").option("path", folder).option("bytes", n)``: path, length, content."""

    @classmethod
    def name(cls):
        return "file_prefix"

    def schema(self):
        return "path string, length long, content binary"

    def reader(self, schema):
        return _PrefixReader(self.options)


def read_prefixes(spark: SparkSession, path: str, n_bytes: int = 1 << 16, files_per_task: int = 64) -> DataFrame:
    """path, length and the first ``n_bytes`` bytes (``content``) of every file below ``path``."""
    spark.dataSource.register(FilePrefix)
    return spark.read.format("file_prefix").option("path", path).option("bytes", n_bytes).option("filesPerTask", files_per_task).load()


def prefix_lines(spark: SparkSession, path: str, n_bytes: int = 1 << 16) -> DataFrame:
    """``(source_file, value)``: the lines that lie whole in the first ``n_bytes`` bytes of every file.

    The last line of a file counts when the file ends with it.  A file whose first line is longer gives none.
    """
    text = F.col("content").cast("string")
    whole = F.col("length") <= n_bytes
    # up to the last line end (a cut character can only lie behind it)
    cut = F.when(whole, text).otherwise(F.when(F.instr(text, "\n") > 0, F.call_function("substring_index", text, F.lit("\n"), F.regexp_count(text, F.lit("\n")))).otherwise(""))
    tag = F.coalesce(F.nullif(F.regexp_extract("path", _PARTITION_VALUE, 1), F.lit("")), F.regexp_extract("path", _FILE_NAME, 1))
    lines = F.split(F.regexp_replace(cut, r"(\r\n|\n|\r)\z", ""), r"\r?\n")
    return (read_prefixes(spark, path, n_bytes).select(tag.alias("source_file"), F.when(F.length(cut) > 0, lines).alias("_l"))
                .select("source_file", F.explode("_l").alias("value")))


# ------------------------------------------------------------------ quoted CSV
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity of the quotes of every range, and its first record start if it begins outside or inside quotes."""
    for b in batches:
        parity, outside, inside = [], [], []
        for path, start, end in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            buf = np.frombuffer(_read(path, start, end - start), np.uint8)
            odd = (np.cumsum(buf == 0x22) & 1).astype(bool)
            line = buf == 0x0A
            first = [int(start + np.argmax(hit) + 1) if hit.any() else None for hit in (line & ~odd, line & odd)]
            parity.append(int(odd[-1]) if len(odd) else 0)
            outside.append(0 if start == 0 else first[0])  # a file's first record begins with the file
            inside.append(first[1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parity, pa.int32()), pa.array(outside, pa.int64()), pa.array(inside, pa.int64())],
                                         [*b.schema.names, "parity", "outside", "inside"])


def _records(header: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first, after in zip(*(c.to_pylist() for c in b.columns)):
                data = _read(path, first, after - first)
                buf = np.frombuffer(data, np.uint8)
                odd = (np.cumsum(buf == 0x22) & 1).astype(bool)
                ends = np.flatnonzero((buf == 0x0A) & ~odd)
                starts = np.append(0, ends + 1)
                ends = np.append(ends, len(buf))
                ends = ends - ((ends > starts) & (buf[np.maximum(ends - 1, 0)] == 0x0D))  # \r\n
                keep = ends > starts  # blank lines are no records
                if header and first == 0 and keep.any():
                    keep[np.argmax(keep)] = False
                starts, ends = starts[keep], ends[keep]
                lo = 0
                while lo < len(starts):
                    hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _OUT)))
                    yield pa.RecordBatch.from_arrays([pa.array([path] * (hi - lo)), pa.array(starts[lo:hi] + first),
                                                      pa.array([data[x:y] for x, y in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist())], pa.binary())],
                                                     ["file", "at", "record"])
                    lo = hi
    return run


def tasks_for(spark: SparkSession, n_ranges: int | None, n_bytes: int | None) -> int:
    """Tasks that read so many ranges: one a range while they are few, else several ranges a task, ``_TASK`` bytes or more."""
    enough = max(_LEAST_TASKS, 4 * spark.sparkContext.defaultParallelism, (n_bytes or 0) // _TASK)
    return min(MAX_TASKS, max(1, n_ranges or 0), enough)


def csv_records(spark: SparkSession, path: str, split_bytes: int = 128 << 20, header: bool = True) -> DataFrame:
    """file, at (byte) and text of every record of the quoted CSV files below ``path``; a header record per file is left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where("length > 0")  # no content
    ranges = (files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))))
                   .select("path", "start", F.least(F.col("start") + split_bytes, F.col("length")).alias("end"), "length"))
    width = tasks_for(spark, *files.agg(F.sum(F.ceil(F.col("length") / split_bytes)), F.sum("length")).first())
    scanned = materialize(ranges.repartition(width, "path", "start").mapInArrow(
        _scan, "path string, start long, end long, length long, parity int, outside long, inside long"), "csv_ranges")
    w = Window.partitionBy("path").orderBy("start")  # one small row per range
    state = F.coalesce(F.sum("parity").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    placed = scanned.withColumn("first", F.when(state == 0, F.col("outside")).otherwise(F.col("inside")))
    placed = placed.withColumn("after", F.coalesce(F.min("first").over(w.rowsBetween(1, Window.unboundedFollowing)), F.col("length")))
    mine = placed.where(F.col("first").isNotNull() & (F.col("first") < F.col("after"))).select("path", "first", "after")
    return (mine.repartition(width, "path", "first").mapInArrow(_records(header), "file string, at long, record binary")
                .select("file", "at", F.col("record").cast("string").alias("record")))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", split_bytes: int = 128 << 20, header: bool = True) -> DataFrame:
    """Typed rows of quoted CSV files by many tasks a file; columns go by position."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", ddl, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    return csv_records(spark, path, split_bytes, header).select(parsed.alias("r")).select("r.*")
