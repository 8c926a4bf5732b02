"""File sources and sinks.

``read_transactions`` replaces a per-file driver loop and row-wise Python parsing with one
scan over all files: ``spark.read.text`` + column expressions, the file name taken from
``_metadata.file_path``.  ``write_clean`` writes one output folder per input file in a
single job (``partitionBy``) instead of ``coalesce(1)`` and a copy/delete pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.datetime import fix_datetime
from ledgerlens.functions.hashing import unit_hash
from ledgerlens.sources.tables import TX_COLUMNS

_PARTITION_VALUE = r"=([^/]+)/[^/]*$"   # .../source_file=<tag>/part-000.txt
_FILE_NAME = r"([^/]+)$"                  # .../<tag>.txt


def parse_transaction_lines(lines: DataFrame, shift_all: bool = False) -> DataFrame:
    """``(source_file, value)`` text lines -> typed transactions; header/comment lines are dropped.

    Fields are split on commas by position (the split runs once per row, in its own projection).
    A field that does not parse becomes NULL (``try_cast``); the datetime goes through
    ``fix_datetime``.  All expressions are built-ins inside whole-stage codegen.
    """
    body = lines.filter(~F.col("value").startswith("#"))
    split = body.select("source_file", F.split(F.col("value"), ",").alias("_f"))
    f = [F.trim(F.get(F.col("_f"), i)) for i in range(len(TX_COLUMNS))]  # int()/float() ignore blanks
    return split.select(
        f[0].try_cast("bigint").alias("tranaction_id"),
        fix_datetime(F.get(F.col("_f"), 1), shift_all=shift_all).alias("tx_datetime"),
        f[2].try_cast("bigint").alias("customer_id"),
        f[3].try_cast("bigint").alias("terminal_id"),
        f[4].try_cast("double").alias("tx_amount"),
        f[5].try_cast("double").alias("tx_time_seconds"),
        f[6].try_cast("int").alias("tx_time_days"),
        f[7].try_cast("int").alias("tx_fraud"),
        f[8].try_cast("int").alias("tx_fraud_scenario"),
        F.col("source_file"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All text files below ``path`` as ``(source_file, value)``.

    The file tag is the file name, or the value of a ``source_file=<tag>`` folder when the files
    were written partitioned (several part files then make up one logical file).
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    fp = F.col("_metadata.file_path")
    tag = F.coalesce(F.nullif(F.regexp_extract(fp, _PARTITION_VALUE, 1), F.lit("")), F.regexp_extract(fp, _FILE_NAME, 1))
    return raw.select(tag.alias("source_file"), "value")


def read_transactions(spark: SparkSession, path: str, shift_all: bool = False) -> DataFrame:
    return parse_transaction_lines(read_lines(spark, path), shift_all=shift_all)


def write_lines(lines: DataFrame, path: str) -> None:
    """One text folder per ``source_file`` (the layout ``read_transactions`` reads back)."""
    lines.write.mode("overwrite").partitionBy("source_file").text(path)


def header_columns(lines: DataFrame) -> DataFrame:
    """``# a | b | c`` header lines -> ``(source_file, position, column_name)``."""
    hdr = lines.filter(F.col("value").startswith("#"))
    names = F.split(F.regexp_replace("value", "#", ""), r"\|")
    return (hdr.select("source_file", F.posexplode(names).alias("pos", "name"))
               .select("source_file", (F.col("pos") + 1).alias("position"), F.trim("name").alias("column_name")))


def sample_rows(df: DataFrame, key: str, fraction: float, *strata: str) -> DataFrame:
    """Deterministic sample: keep a row when md5(key) maps below ``fraction``.

    Being per-row it keeps about ``fraction`` of every stratum (e.g. of each day) without
    a shuffle; the same rows come back on every run and in any engine.
    """
    return df.filter(unit_hash(key, *strata) < F.lit(fraction)) if strata else df.filter(unit_hash(key) < F.lit(fraction))


def random_sample(df: DataFrame, fraction: float, seed: int = 7) -> DataFrame:
    """Random Bernoulli sample (the notebook's ``sample(frac=...)``): each row is kept independently,
    so every day keeps about ``fraction`` of its rows; no list of strata is built on the driver."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def write_clean(df: DataFrame, path: str, by: str = "source_file") -> None:
    """One parquet folder per value of ``by``, written in one distributed job.

    Only the folders this run writes are replaced (dynamic partition overwrite), as the original
    replaced each input file's output on its own: a run over today's files leaves earlier outputs
    alone, and a re-run of the same files replaces them.  No shuffle before the write: every task
    writes its own part file into each folder it touches, so a file holding a third of all rows is
    still written by many tasks.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_table(df: DataFrame, path: str | None, fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Append to a folder, or (``path=None``) to what ``options`` name, such as a JDBC url and table."""
    df.write.mode("append").format(fmt).options(**(options or {})).save(path)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    t = spark.table(name)
    return t.select(*columns) if columns else t


# -------------------------------------------------------- delimited table loads

RATING_SCHEMA = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("dates", T.DateType()),
    T.StructField("count", T.IntegerType()),
])

REVIEWS_SCHEMA = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("created_time", T.TimestampNTZType()),
    T.StructField("country", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("embeddings", T.StringType()),
])


def load_table_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   vector_cols: tuple[str, ...] = (), split_bytes: int | None = None) -> DataFrame:
    """``COPY table FROM file DELIMITER sep HEADER CSV``: positional columns; ``[..]`` vector text -> array<float>.

    Quoted fields may hold the separator, doubled quotes and line breaks, so a file is read by one
    task, unless ``split_bytes`` is given: then by one task for so many bytes (``ranges.read_quoted_csv``).  Fixed-width
    ``char(n)`` columns are trimmed on load (they compare without trailing blanks).
    """
    if split_bytes:
        from ledgerlens.sources.ranges import read_quoted_csv
        df = read_quoted_csv(spark, path, schema, sep, split_bytes)
    else:
        df = (spark.read.option("header", "true").option("sep", sep).option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", "true")
              .option("enforceSchema", "true").schema(schema).csv(path))
    for c in vector_cols:
        df = df.withColumn(c, F.from_json(F.col(c), "array<float>"))
    for fld in schema.fields:
        if isinstance(fld.dataType, T.StringType) and fld.name in ("source", "sentiment"):
            df = df.withColumn(fld.name, F.rtrim(fld.name))
    return df


def write_table_csv(df: DataFrame, path: str, sep: str = ",", vector_cols: tuple[str, ...] = ()) -> None:
    for c in vector_cols:
        df = df.withColumn(c, F.to_json(F.col(c)))
    (df.write.mode("overwrite").option("header", "true").option("sep", sep).option("quote", '"').option("escape", '"')
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
