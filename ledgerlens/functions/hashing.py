"""Deterministic pseudo-random numbers from md5, reproducible in any SQL engine.

``unit_hash`` maps a key to [0, 1) from the first 32 bits of md5(key); DuckDB
computes the same number with ``('0x' || substr(md5(key), 1, 8))::BIGINT / 2^32``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = float(2 ** 32)

def _poisson1_cdf(k_max: int = 12) -> list[float]:
    """P(K <= k) for K ~ Poisson(1), k = 0..k_max (built from the series e^-1 * sum 1/j!)."""
    out, term, acc = [], math.exp(-1.0), 0.0
    for j in range(k_max + 1):
        if j:
            term /= j
        acc += term
        out.append(acc)
    return out


POISSON1_CDF = _poisson1_cdf()


def key_hash(*keys) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]))


def unit_hash(*keys) -> Column:
    return F.conv(F.substring(key_hash(*keys), 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_32)


def poisson1_of(digest, part: int = 0) -> Column:
    """Inverse CDF of Poisson(1) at 32 bits of an md5 (``part`` 0 to 3): the weight of a row in a bootstrap replicate.

    Hex digits of equal length compare as the numbers do, so no number is parsed.
    """
    bits = F.substring(digest, 1 + 8 * part, 8)
    bounds = [math.ceil(p * _TWO_32) for p in POISSON1_CDF]
    w = F.lit(0)
    for b in bounds:
        if b < _TWO_32:
            w = w + (bits >= F.lit(f"{b:08x}")).cast("int")
    return w
