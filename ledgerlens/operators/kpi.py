"""Review and rating KPIs.

The dashboard issued one SQL query per KPI and per day.  Here each KPI is a
DataFrame over the whole table; the ``*_series`` forms compute every date at once
from one daily aggregate, and day-over-day changes are an equi-join of that
daily table with itself shifted by one calendar day (a missing yesterday gives
NULL, unlike ``lag``).  Daily tables have one row per calendar day, so every
operation after the first aggregate is small, however large the review table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEGATIVE = "NEGATIVE"


def round_half_up(x: Column, digits: int = 2) -> Column:
    """Round the decimal reading of a double (``2.675 -> 2.68``), identically in any SQL engine."""
    return F.round(x.cast("decimal(24,10)"), digits).cast("double")


def pct(x: Column) -> Column:
    """A share in [0, 1] as a whole percent (``round(100·x)``; the original truncated 0.29 to 28)."""
    return F.round(x.cast("decimal(24,10)") * 100, 0).cast("int")


def _day(ts: str = "created_time") -> Column:
    return F.to_date(F.col(ts))


def _upto(as_of: str, ts: str = "created_time", inclusive: bool = True) -> Column:
    """Rows up to ``as_of``.  ``inclusive=False`` is the histogram's original ``created_time <= midnight``."""
    if inclusive:
        return F.col(ts) < F.to_timestamp_ntz(F.lit(as_of)) + F.expr("INTERVAL 1 DAY")
    return F.col(ts) <= F.to_timestamp_ntz(F.lit(as_of))


def neg_flag(col: str = "sentiment") -> Column:
    return F.when(F.col(col) == NEGATIVE, 1).otherwise(0)


def avg_score(rv: DataFrame, as_of: str) -> DataFrame:
    """Mean score of all reviews up to ``as_of`` (inclusive), rounded to 2 places."""
    return rv.filter(_upto(as_of)).agg(round_half_up(F.avg("score")).alias("avg_score"))


def neg_share(rv: DataFrame, as_of: str) -> DataFrame:
    """Share of negative reviews up to ``as_of``, as a whole percent (``round(100·x)``)."""
    return rv.filter(_upto(as_of)).agg(pct(F.avg(neg_flag())).alias("neg_pct"))


def score_histogram(rv: DataFrame, as_of: str, inclusive: bool = True, stars=(1, 2, 3, 4, 5)) -> DataFrame:
    """Count per star up to ``as_of``: one row, one column per star, zero when a star has no reviews."""
    return rv.filter(_upto(as_of, inclusive=inclusive)).agg(
        *[F.count_if(F.col("score") == s).alias(f"n_{s}") for s in stars])


def _window(as_of: str, days: int) -> Column:
    d = F.to_date(F.lit(as_of))
    return (_day() <= d) & (_day() > F.date_sub(d, days))


def daily_rating(rv: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per day in ``(as_of - days, as_of]``: mean score rounded to 2 places, ordered by day."""
    return (rv.filter(_window(as_of, days)).groupBy(_day().alias("dt"))
              .agg(round_half_up(F.avg("score")).alias("avg_score")).orderBy("dt"))


def daily_neg(rv: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per day in ``(as_of - days, as_of]``: negative share as a whole percent."""
    return (rv.filter(_window(as_of, days)).groupBy(_day().alias("dt"))
              .agg(pct(F.avg(neg_flag())).alias("neg_pct")).orderBy("dt"))


def source_score(rt: DataFrame, as_of: str) -> DataFrame:
    """Mean stored rating per source up to ``as_of`` - every source in one pass."""
    return (rt.filter(F.col("dates") <= F.to_date(F.lit(as_of))).groupBy("source")
              .agg(round_half_up(F.avg("score")).alias("avg_score")))


def star_histogram(rv: DataFrame, by: str = "source") -> DataFrame:
    """Per source: ``map<star, count>`` (the shape the store APIs return); reviews without a score are skipped
    (a map cannot have a NULL key)."""
    per_star = rv.filter(F.col("score").isNotNull()).groupBy(by, "score").agg(F.count(F.lit(1)).alias("n"))
    return per_star.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("score", "n"))).alias("stars"))


def weighted_rating(hist: DataFrame, by: str = "source") -> DataFrame:
    """``Σ star·count / Σ count`` and the total count from a star histogram map."""
    e = F.map_entries("stars")
    total = F.aggregate(e, F.lit(0).cast("bigint"), lambda acc, x: acc + x["value"])
    weighted = F.aggregate(e, F.lit(0).cast("bigint"), lambda acc, x: acc + x["key"] * x["value"])
    return hist.select(by, (weighted / total).alias("score"), total.alias("count"))


# ----------------------------------------------------------- day over day

def daily_values(df: DataFrame, value: Column, name: str, ts: str = "created_time", by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by, F.to_date(F.col(ts)).alias("dt")).agg(F.avg(value).alias(name))


def day_over_day(daily: DataFrame, name: str, by: list[str] | None = None, digits: int = 2) -> DataFrame:
    """value(d) - value(d - 1 calendar day) for every day; NULL when the day before has no rows.

    Each day's row is sent to its own day and to the next one and regrouped, so the daily table is
    computed once; no single-partition window, and gaps in the calendar are honoured.
    """
    by = by or []
    own = F.struct(F.col("dt").alias("dt"), F.lit(True).alias("own"))
    both = F.when(F.col("dt").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.date_add("dt", 1).alias("dt"), F.lit(False).alias("own"))))
    sent = daily.select(*by, F.col(name).alias("_v"), F.explode(both).alias("_to")).select(*by, "_v", "_to.dt", "_to.own")
    j = sent.groupBy(*by, "dt").agg(F.max(F.when(F.col("own"), F.col("_v"))).alias(name),
                                    F.max(F.when(~F.col("own"), F.col("_v"))).alias("_prev"),
                                    F.max("own").alias("_has")).filter("_has")
    change = F.col(name) - F.col("_prev")
    return j.select(*by, "dt", round_half_up(F.col(name), digits).alias(name),
                    round_half_up(change, digits).alias("change"),
                    F.when(change < 0, "-").when(change.isNotNull(), "+").alias("sign"))


def kpi_change(df: DataFrame, value: Column, as_of: str, ts: str = "created_time", digits: int = 2) -> DataFrame:
    """Today's mean minus yesterday's mean in one pass (two conditional averages, no join)."""
    d = F.to_date(F.lit(as_of))
    day = F.to_date(F.col(ts))
    t = F.avg(F.when(day == d, value))
    y = F.avg(F.when(day == F.date_sub(d, 1), value))
    window = df.filter((day == d) | (day == F.date_sub(d, 1)))
    r = window.agg(t.alias("t"), y.alias("y"))
    ch = F.col("t") - F.col("y")
    return r.select(round_half_up(F.col("t"), digits).alias("today"),
                    round_half_up(F.col("y"), digits).alias("yesterday"),
                    round_half_up(ch, digits).alias("change"), F.when(ch < 0, "-").when(ch.isNotNull(), "+").alias("sign"))


def kpi_change_cross_join(df: DataFrame, value: Column, as_of: str, ts: str = "created_time", digits: int = 2) -> DataFrame:
    """The original two one-row aggregates joined: ``today CROSS JOIN yesterday`` (both exactly one row)."""
    d = F.to_date(F.lit(as_of))
    day = F.to_date(F.col(ts))
    today = df.filter(day == d).agg(F.avg(value).alias("t"))
    yest = df.filter(day == F.date_sub(d, 1)).agg(F.avg(value).alias("y"))
    ch = F.col("t") - F.col("y")
    return today.crossJoin(F.broadcast(yest)).select(
        round_half_up(F.col("t"), digits).alias("today"), round_half_up(F.col("y"), digits).alias("yesterday"),
        round_half_up(ch, digits).alias("change"), F.when(ch < 0, "-").when(ch.isNotNull(), "+").alias("sign"))


def top_k(df: DataFrame, k: int, order: str = "id", cols: list[str] | None = None) -> DataFrame:
    """First ``k`` rows by ``order`` (page p of a 100-row view is ``k = 100·p``): a TakeOrderedAndProject."""
    out = df.select(*cols) if cols else df
    return out.orderBy(order).limit(k)
