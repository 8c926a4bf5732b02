"""Byte prefixes, split CSV and serial ids."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import scratch_path
from ledgerlens.sources import files, ranges, serial

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("content", T.StringType()), T.StructField("at", T.TimestampNTZType()),
                       T.StructField("vec", T.StringType())])


def folder(tmp_path, contents):
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def test_prefixes(spark, tmp_path):
    at = folder(tmp_path, {"a.txt": b"# x | y\n1,2\n3,4\n", "b.txt": b"# x | y\r\n" + b"5,6\r\n" * 1000, "s=c.txt/part-0": "é\nlong".encode() + b"z" * 99,
                           "empty.txt": b"", "one.txt": b"q" * 50, "_hidden": b"no\n", "last.txt": b"abc"})
    got = {os.path.basename(r["path"]): (r["length"], bytes(r["content"])) for r in ranges.read_prefixes(spark, at, 20, files_per_task=2).collect()}
    assert got["b.txt"] == (5009, (b"# x | y\r\n" + b"5,6\r\n" * 3)[:20]) and got["empty.txt"] == (0, b"") and "_hidden" not in got
    assert all(len(c) <= 20 for _, c in got.values()) and len(got) == 6
    assert ranges.read_prefixes(spark, at, 20, files_per_task=2).rdd.getNumPartitions() == 3
    lines = {}
    for r in ranges.prefix_lines(spark, "file:" + at, 20).collect():
        lines.setdefault(r["source_file"], []).append(r["value"])
    assert lines == {"a.txt": ["# x | y", "1,2", "3,4"], "b.txt": ["# x | y", "5,6", "5,6"], "c.txt": ["é"], "last.txt": ["abc"]}
    head = {(r["source_file"], r["position"]): r["column_name"] for r in files.header_columns(ranges.prefix_lines(spark, at, 20)).collect()}
    assert head == {("a.txt", 1): "x", ("a.txt", 2): "y", ("b.txt", 1): "x", ("b.txt", 2): "y"}


TEXTS = ['plain', 'two\nlines', 'say ""hi""', ',', '', '\n\n', 'é, "x"\r\nß', '""', 'end"', "a" * 300 + "\n" * 40, None, ' blank ']


def written(tmp_path, eol="\n"):
    """Files and their (id, content); an empty field is NULL, quoted or not, as Spark's reader has it."""
    rows, body = [], ["id,content,at,vec"]
    for i in range(48):
        t = TEXTS[i * 7 % len(TEXTS)]
        rows.append((i, t or None))
        field = "" if t is None else '"' + t.replace('"', '""') + '"'
        body.append(f'{i},{field},2024-01-0{i % 9 + 1} 0{i % 10}:00:00,"[{i},0.5]"')
    return folder(tmp_path, {"one.csv": (eol.join(body) + eol).encode(), "two.csv": (body[0] + eol + body[3]).encode(), "three.csv": b"id,content,at,vec\n"}), rows


@pytest.mark.parametrize("split", [31, 700, 1 << 20])
def test_split_csv_equals_the_one_task_read(spark, tmp_path, split):
    at, rows = written(tmp_path)
    whole = files.load_table_csv(spark, at, SCHEMA, vector_cols=("vec",))
    parts = files.load_table_csv(spark, at, SCHEMA, vector_cols=("vec",), split_bytes=split)
    assert parts.dtypes == whole.dtypes
    key = lambda df: sorted(map(str, df.collect()))
    assert key(parts) == key(whole) and len(parts.collect()) == 49
    assert {r["id"]: r["content"] for r in parts.collect()} == dict(rows)
    if split == 31:
        assert ranges.csv_records(spark, at, split).rdd.getNumPartitions() > 50  # many tasks for one file


def test_split_csv_with_other_line_ends_and_separator(spark, tmp_path):
    at, rows = written(tmp_path, "\r\n")
    got = ranges.read_quoted_csv(spark, at, SCHEMA, split_bytes=301).collect()
    assert {r["id"]: r["content"] for r in got} == dict(rows) and all(r["at"] is not None and r["vec"].endswith("0.5]") for r in got)
    other = folder(tmp_path / "p", {"x": b'1|"a|\n|b"\n\n2|c\n'})
    two = T.StructType(SCHEMA.fields[:2])
    assert sorted(map(tuple, ranges.read_quoted_csv(spark, other, two, sep="|", split_bytes=3, header=False).collect())) == [(1, "a|\n|b"), (2, "c")]


def test_serial_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("id"))
    got = sorted((r["id"], r["k"]) for r in serial.with_serial_ids(df.repartition(7), ["k"], 10).collect())
    assert got == [(11 + i, i) for i in range(1000)]
    assert serial.with_serial_ids(df.where("false"), ["k"]).count() == 0


def test_appends_with_serial_ids(spark):
    path = scratch_path(spark, "serial_test")
    load = lambda n, lo: spark.range(lo, lo + n).select(F.col("id").alias("k")).repartition(3)
    read = lambda: sorted((r["id"], r["k"], r["batch_id"]) for r in spark.read.parquet(path).collect())
    serial.append_serial(load(50, 100), path, 1, ["k"])
    serial.append_serial(load(30, 500), path, 2, ["k"])
    want = [(i + 1, 100 + i, 1) for i in range(50)] + [(51 + i, 500 + i, 2) for i in range(30)]
    assert read() == want
    for batch, df in ((2, load(30, 500)), (1, load(50, 100))):  # retries
        serial.append_serial(df, path, batch, ["k"])
        assert read() == want
    with pytest.raises(ValueError):
        serial.append_serial(load(60, 100), path, 1, ["k"])
    assert read() == want
