"""Profiling of raw and typed transactions.

The notebook read the first megabytes of each file into pandas, one file at a time.
Here every statistic is one grouped aggregate over all files: each is partially
aggregated on the map side, so a file holding a third of the rows costs no more
than its share of scan time.  Per-day percentiles use ``percentile`` (linear
interpolation, as numpy), whose buffer holds one counter per distinct value; per-file
quartiles are ranks over a table of value counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions.datetime import datetime_parts, epoch_seconds, fix_datetime
from ledgerlens.operators.statsjoin import join_stats
from ledgerlens.session import materialize
from ledgerlens.sources.tables import TX_COLUMNS

# Pandas dtype names reported per column, ordered from narrowest to widest.
DTYPES = ("int64", "float64", "object")
DT_PARTS = ("year", "month", "day", "hour", "minute", "second")


def _missing(c: str, dtype: str) -> F.Column:
    col = F.col(c)
    return col.isNull() | F.isnan(col) if dtype in ("double", "float") else col.isNull()


def column_profile(df: DataFrame, by: str = "source_file", columns: Sequence[str] | None = None) -> DataFrame:
    """Per file and column: rows, missing values, share missing; plus an ``*`` row per column for all files.

    Rows are aggregated once, per file; the totals are sums of those few rows.  A flag tells the total
    from a NULL file name.
    """
    types = dict(df.dtypes)
    cols = [c for c in (columns or df.columns) if c != by]
    per_file = df.groupBy(by).agg(F.count(F.lit(1)).alias("nrows"),
                                  *[F.count_if(_missing(c, types[c])).alias(f"na__{c}") for c in cols])
    levels = per_file.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("_total"))
    key = F.when(F.col("_total"), F.lit("*")).otherwise(F.col(by))
    sums = ["nrows", *[f"na__{c}" for c in cols]]
    g = levels.groupBy("_total", key.alias(by)).agg(*[F.sum(c).alias(c) for c in sums])
    long = g.select(by, "nrows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"na__{c}").alias("na")) for c in cols])).alias("_p"))
    return long.select(by, F.col("_p.column_name").alias("column_name"), "nrows", F.col("_p.na").alias("na"),
                       (F.col("_p.na") / F.col("nrows")).alias("pct_na"))


def _value_kind(text: F.Column) -> F.Column:
    """0 = integer, 1 = float or missing (pandas turns a column with blanks into float), 2 = text."""
    t = F.trim(text)
    return (F.when((t == "") | t.isNull(), 1)
             .when(t.rlike(r"^[+-]?[0-9]+$"), 0)
             .when(t.try_cast("double").isNotNull(), 1)
             .otherwise(2))


def schema_drift(lines: DataFrame, n_fields: int = len(TX_COLUMNS)) -> DataFrame:
    """Per column name: the dtypes it took across files, how many files have it, and the files lacking it.

    A column's dtype in one file is the widest kind of any of its values (int64 < float64 < object);
    values are attributed to the header name at the same position in that file.  The text is read
    once: header line and value kinds per file are written, and the rest works on that table.  Only
    the set of column names is one broadcast row; which file lacks which of them are rows.
    """
    is_hdr = F.col("value").startswith("#")
    split = lines.select("source_file", "value", is_hdr.alias("_h"), F.split("value", ",").alias("_f"))
    per_file = split.groupBy("source_file").agg(
        F.max(F.when(F.col("_h"), F.col("value"))).alias("_hdr"),
        *[F.max(F.when(~F.col("_h"), _value_kind(F.get(F.col("_f"), i)))).alias(f"k{i + 1}") for i in range(n_fields)])
    names = F.transform(F.split(F.regexp_replace("_hdr", "#", ""), r"\|"), lambda x: F.trim(x))
    kinds = F.array(*[F.col(f"k{i + 1}") for i in range(n_fields)])
    headed = materialize(per_file.filter(F.col("_hdr").isNotNull())
                                 .select("source_file", names.alias("_names"), kinds.alias("_k")), "per_file")
    dt = F.array(*[F.lit(x) for x in DTYPES])
    pairs = headed.select("source_file", "_k", F.posexplode("_names").alias("pos", "column_name"))
    per_col = pairs.groupBy("column_name").agg(
        F.array_join(F.array_sort(F.collect_set(F.element_at(dt, F.get("_k", F.col("pos")) + 1))), ",").alias("dtypes"),
        F.count(F.lit(1)).alias("n_files"))
    every = per_col.agg(F.collect_set("column_name").alias("_every"))  # one row: the distinct column names
    absent = (headed.crossJoin(F.broadcast(every))
                    .select("source_file", F.explode(F.array_except("_every", "_names")).alias("column_name"))
                    .groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_set("source_file")), ",").alias("absent_in")))
    return (per_col.join(absent, "column_name", "left")
                   .select("column_name", "dtypes", "n_files", F.coalesce("absent_in", F.lit("")).alias("absent_in")))


def datetime_domain(lines: DataFrame) -> DataFrame:
    """Per file and date part: distinct values seen (sorted), min, max; plus the count of unparseable texts.

    Only texts with two blank-separated parts of the ``Y-m-d H:M:S`` layout contribute values; the
    parts are at most four digits, so each set of distinct values is small whatever the data size.
    """
    body = lines.filter(~F.col("value").startswith("#"))
    staged = body.select("source_file", datetime_parts(F.get(F.split("value", ","), 1)).alias("_dt"))
    per = staged.groupBy("source_file").agg(
        F.count_if(F.col("_dt").isNull()).alias("n_bad"),
        *[F.array_sort(F.collect_set(F.get(F.col("_dt"), i))).alias(p) for i, p in enumerate(DT_PARTS)])
    long = per.select("source_file", "n_bad", F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(p).alias("vals")) for p in DT_PARTS])).alias("_p"))
    return long.select(
        "source_file", F.col("_p.part").alias("part"),
        F.array_join(F.col("_p.vals"), ",").alias("distinct_values"),
        F.array_min("_p.vals").alias("min_value"), F.array_max("_p.vals").alias("max_value"), "n_bad")


def datetime_bad_values(lines: DataFrame) -> DataFrame:
    """The unparseable datetime texts, one row per (file, text) with its count (no list on the driver)."""
    body = lines.filter(~F.col("value").startswith("#"))
    staged = body.select("source_file", F.get(F.split("value", ","), 1).alias("text"))
    return staged.filter(fix_datetime("text").isNull()) \
                 .groupBy("source_file", "text").agg(F.count(F.lit(1)).alias("n"))


BINS = 128


def _quartiles(counts: DataFrame, col: str, by: str) -> DataFrame:
    """Exact quartiles (linear interpolation) of each group of a ``(by, value, n)`` table.

    Ranks are running totals in two steps, within the parts between ``BINS`` approximate percentiles of the group's
    distinct values and over the parts, so that a group with very many distinct values is many tasks of like size, whatever
    its outliers.
    """
    cuts = counts.groupBy(by).agg(F.percentile_approx(col, [i / BINS for i in range(1, BINS)], 4 * BINS).alias("_cuts"), F.sum("n").alias("_all"))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(col)))
    placed = join_stats(counts, cuts, [by]).withColumn("_part", below).drop("_cuts")
    parts = placed.groupBy(by, "_part").agg(F.sum("n").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(by).orderBy("_part")) - F.col("_n")  # at most BINS rows a group
    parts = parts.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), before.alias("_before"))
    run = Window.partitionBy(by, "_part").orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(parts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_p"))).withColumn("_to", F.col("_before") + F.sum("n").over(run))
    at = {}
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        at[name] = (F.col("_all") - 1) * F.lit(share)
    value = []
    for name, pos in at.items():  # the value at rank r (from 0) is the smallest with more than r rows up to it
        value += [F.min(F.when(F.col("_to") > F.floor(pos), F.col(col))).alias(f"_f_{name}"),
                  F.min(F.when(F.col("_to") > F.ceil(pos), F.col(col))).alias(f"_c_{name}"),
                  F.first(pos - F.floor(pos)).alias(f"_w_{name}")]
    g = ranked.groupBy(by).agg(*value)
    return g.select(by, *[((1 - F.col(f"_w_{name}")) * F.col(f"_f_{name}") + F.col(f"_w_{name}") * F.col(f"_c_{name}")).alias(name)
                          for name in at])


def box_stats(df: DataFrame, col: str = "tx_amount", by: str = "source_file") -> DataFrame:
    """Data behind a box plot: quartiles, 1.5·IQR whiskers (most extreme values inside), outlier count.

    Everything after the first aggregate works on counts per (file, value).
    """
    counts = materialize(df.filter(F.col(col).isNotNull()).groupBy(by, F.col(col).cast("double").alias(col))
                           .agg(F.count(F.lit(1)).alias("n")), "value_counts")
    q = materialize(_quartiles(counts, col, by), "quartiles")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col(col) >= F.col("q1") - reach) & (F.col(col) <= F.col("q3") + reach)
    return join_stats(counts, q, [by], written=True).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_low"), F.max(F.when(inside, F.col(col))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"))


def value_share(df: DataFrame, col: str, by: str = "source_file") -> DataFrame:
    """Normalised value counts per file (``value_counts(normalize=True).sort_index()``)."""
    counts = df.groupBy(by, col).agg(F.count(F.lit(1)).alias("n"))
    # window over the aggregated table: a file has as many rows as distinct values
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by))).orderBy(by, col)


def histogram(df: DataFrame, ts: str = "tx_datetime", bins: int = 99, by: str = "source_file") -> DataFrame:
    """Equal-width bins of the epoch seconds between each file's min and max (the last bin holds the max)."""
    d = df.select(by, epoch_seconds(ts).alias("_s")).filter(F.col("_s").isNotNull())
    rng = d.groupBy(by).agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    d = join_stats(d, rng, [by])
    span = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1))
    b = F.least(F.floor((F.col("_s") - F.col("_lo")) * bins / span) + 1, F.lit(bins)).cast("int")
    h = d.groupBy(by, b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return h.select(by, "bin", "n",
                    (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"))


def daily_percentiles(df: DataFrame, col: str = "tx_amount", ts: str = "tx_datetime", by: str = "source_file",
                      qs: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Per file and date: the 5th, 50th and 95th percentiles of the amount (rows with amount and seconds)."""
    d = df.filter(F.col(col).isNotNull() & F.col("tx_time_seconds").isNotNull() & F.col(ts).isNotNull())
    g = d.groupBy(by, F.to_date(ts).alias("date")).agg(F.percentile(col, list(qs)).alias("_q"))
    return g.select(by, "date", F.col("_q")[0].alias("amount_lower"), F.col("_q")[1].alias("amount_median"),
                    F.col("_q")[2].alias("amount_higher"))


def robust_cap(daily: DataFrame) -> DataFrame:
    """Per date: median over files of the daily 95th percentile; and the global median of all of them (the cap)."""
    per_date = daily.groupBy("date").agg(F.median("amount_higher").alias("median_p95"))
    cap = daily.agg(F.median("amount_higher").alias("cap"))  # one row
    return per_date.crossJoin(F.broadcast(cap))


def residual_std(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.stddev_samp(col).alias("std"))


__all__ = ["column_profile", "schema_drift", "datetime_domain", "datetime_bad_values", "box_stats", "value_share",
           "histogram", "daily_percentiles", "robust_cap", "residual_std"]
