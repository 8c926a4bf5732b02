"""Timestamp expressions that do not depend on the session time zone.

Driver tables carry ``TIMESTAMP_NTZ``; epoch arithmetic is done against the
NTZ epoch so results are the same whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
DAY_MICROS = DAY_SECONDS * 1_000_000

# Fixed layout of the transaction date text: ``Y-m-d H:M:S`` (two blank-separated parts, 4-digit year).
_DT_PATTERN = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"
_H24_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} 24:\d{1,2}:\d{1,2}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of an NTZ timestamp (like ``unix_timestamp``)."""
    return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})".format(_sql(ts)))


def epoch_micros(ts) -> Column:
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})".format(_sql(ts)))


def _sql(ts) -> str:
    if isinstance(ts, str):
        return f"`{ts}`"
    raise TypeError("pass a column name")


def utc_instant(ts) -> Column:
    """NTZ wall clock -> TIMESTAMP instant with the same UTC reading (for watermarks/windows)."""
    return F.timestamp_micros(epoch_micros(ts))


def _squeeze(text) -> Column:
    return F.regexp_replace(F.trim(_col(text)), r"\s+", " ")


def datetime_parts(text) -> Column:
    """``array<int>[Y, m, d, H, M, S]`` of a ``Y-m-d H:M:S`` text, NULL when the layout does not match."""
    s = _squeeze(text)
    parts = F.split(s, "[- :]")
    return F.when(s.rlike(_DT_PATTERN), F.array(*[F.get(parts, i).try_cast("int") for i in range(6)]))


def fix_datetime(text, shift_all: bool = False) -> Column:
    """Parse ``Y-m-d H:M:S`` text to TIMESTAMP_NTZ; hour 24 means 00 of the next day; malformed -> NULL.

    The text is checked against the layout once, hour 24 is rewritten, and the string is cast
    with ``try_cast`` (an impossible date such as Feb 30 or second 60 gives NULL).  The
    expression refers to the text only a few times, so it stays cheap even where the optimizer
    inlines it into a pushed-down filter.  ``shift_all=True`` reproduces the original job, which
    added one hour to every row (after turning hour 24 into 23).
    """
    s = _squeeze(text)
    ok = s.rlike(_DT_PATTERN)
    h24 = s.rlike(_H24_PATTERN)
    if shift_all:
        ts = F.regexp_replace(s, " 24:", " 23:").try_cast("timestamp_ntz")
        return F.when(ok, ts + F.expr("INTERVAL 1 HOUR"))
    ts = F.when(h24, F.regexp_replace(s, " 24:", " 00:")).otherwise(s).try_cast("timestamp_ntz")
    return F.when(ok, F.when(h24, ts + F.expr("INTERVAL 1 DAY")).otherwise(ts))


def is_hour_24(text) -> Column:
    return _squeeze(text).rlike(_H24_PATTERN)
