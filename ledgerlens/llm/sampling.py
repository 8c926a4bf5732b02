"""Bounded samples of large tables: the rows with the smallest hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 31


def smallest(df: DataFrame, limit: int, hashed: Column, total: int) -> DataFrame:
    """At most ``limit`` rows of ``df`` (of about ``total``), those with the smallest hashes.

    Only hashes under twice the wanted share are sorted, so about 2 * ``limit`` rows move at any
    size of the table.
    """
    h = F.pmod(hashed, F.lit(_RANGE))
    share = min(1.0, 2 * limit / max(total, 1))
    return df.where(h < int(share * _RANGE)).orderBy(h).limit(limit)
