"""Joining a large table with statistics of its own groups (one row per group).

The statistics are written and counted first.  Few groups: they are broadcast, and the large
table is not shuffled.  Many groups: the rows of a group are dealt over ``SALT`` sub-keys and its
statistics repeated for each, so that one hot group is never one task.  Both give the same rows.  A NULL group meets
its own statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import materialize

# Statistics rows hold a key and a few numbers: 200,000 of them are some 20 MB.
BROADCAST_GROUPS = 200_000
SALT = 32


def join_stats(df: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "left",
               broadcast_groups: int = BROADCAST_GROUPS, written: bool = False) -> DataFrame:
    """``df`` with the statistics of its group; without ``by`` the statistics are exactly one row.

    ``written``: ``stats`` is a written table already.
    """
    by = list(by)
    if not by:
        return df.crossJoin(F.broadcast(stats))
    stats = stats if written else materialize(stats, "stats")
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    named = stats.withColumnsRenamed({c: f"_by{i}" for i, c in enumerate(by)})
    drop = [f"_by{i}" for i in range(len(by))]
    if stats.count() <= broadcast_groups:  # the row count of a parquet table comes from its footers
        return df.join(F.broadcast(named), same, how).drop(*drop)
    salted = named.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    keyed = df.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(df, by)), F.lit(SALT)).cast("int"))
    return keyed.join(salted, same & (F.col("_salt") == F.col("_of")), how).drop("_salt", "_of", *drop)


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_holds_map(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType)) or (isinstance(t, T.ArrayType) and _holds_map(t.elementType))


def _hashable(df: DataFrame, by: list[str]) -> list[Column]:
    """What a row's salt is taken from: its other columns, without those that hold maps (the size of a map stands for it)."""
    rest = [f for f in df.schema.fields if f.name not in by]
    return [F.col(f"`{f.name}`") for f in rest if not _holds_map(f.dataType)] + [F.size(f"`{f.name}`") for f in rest if isinstance(f.dataType, T.MapType)]
