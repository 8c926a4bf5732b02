"""Serial ids for loads and appends.

Rows are ordered by a key with a range shuffle and written; an id is the largest stored id, plus the rows of the files
before, plus the row's place in its file.  Only one row count per file reaches the driver (as many as the shuffle is wide);
there is no window over the table.  Ids are 1..n without gaps, and the same on a retry when the key is unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerlens.session import materialize, scratch_path

_PART = r"part-(\d+)[^/]*?(?:-c(\d+))?\.[^/]*$"


def with_serial_ids(df: DataFrame, order: list[str], start: int = 0, id_col: str = "id") -> DataFrame:
    """``df`` with ``id_col`` = ``start`` + 1, ``start`` + 2, ... in the order of the columns ``order`` (nulls first)."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "serial")
    keys = [F.col(c).asc_nulls_first() for c in order]
    rows = materialize(df.drop(id_col), "serial_rows")  # the range shuffle reads its rows twice: once for the bounds
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
    stored = spark.read.parquet(path)
    place = F.col("_metadata.file_path")
    counts = (stored.groupBy(place.alias("_file")).agg(F.count(F.lit(1)).alias("n"))
                    .select("_file", "n", *(F.coalesce(F.regexp_extract("_file", _PART, i).try_cast("long"), F.lit(0)).alias(f"p{i}") for i in (1, 2))).collect())
    offsets, at = [], start
    for r in sorted(counts, key=lambda r: (r["p1"], r["p2"])):
        offsets.append((r["_file"], at))
        at += r["n"]
    before = spark.createDataFrame(offsets, "_file string, _before long")
    return (stored.withColumns({"_file": place, "_row": F.col("_metadata.row_index")}).join(F.broadcast(before), "_file")
                  .select((F.col("_before") + F.col("_row") + 1).alias(id_col), *[c for c in df.columns if c != id_col]))


def stored_batches(spark: SparkSession, path: str, id_col: str = "id") -> dict:
    """batch -> (smallest id, largest id) of a table written by ``append_serial``."""
    try:
        t = spark.read.parquet(path)
    except AnalysisException:
        return {}
    return {r["batch_id"]: (r["a"], r["b"]) for r in t.groupBy("batch_id").agg(F.min(id_col).alias("a"), F.max(id_col).alias("b")).collect()}


def append_serial(df: DataFrame, path: str, batch: int, order: list[str], id_col: str = "id") -> None:
    """Append ``df`` as ``batch``, its ids after those of all earlier batches; the same batch again replaces itself.

    A batch that would run into the ids of a later one is refused.
    """
    spark = df.sparkSession
    known = stored_batches(spark, path, id_col)
    start = max((b for k, (_, b) in known.items() if k < batch), default=0)
    rows = with_serial_ids(df, order, start, id_col)
    later = [a for k, (a, _) in known.items() if k > batch]
    if later and start + rows.count() >= min(later):
        raise ValueError(f"batch {batch} holds more rows than before: its ids would meet those of a later batch")
    rows.withColumn("batch_id", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
