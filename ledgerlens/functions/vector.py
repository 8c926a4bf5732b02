"""Vector expressions on ``array<float|double>`` columns (no built-in L2 distance in Spark SQL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def l2_distance(a, b) -> Column:
    """Euclidean distance, computed in double precision, element by element in the JVM."""
    sq = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, v: acc + v))
