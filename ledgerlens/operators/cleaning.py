"""Projections, filters and cleaning of transactions.

The original job looped over files on the driver and fitted a regression on the first
10 000 rows of each.  Here one plan covers every file: the regression statistics are a
grouped aggregate keyed by ``source_file`` (partial aggregation on the map side, so a
file holding a third of all rows is still spread over every task), and the per-file
statistics - one row per file - are joined back without shuffling the rows (``statsjoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.datetime import epoch_seconds, fix_datetime, is_hour_24
from ledgerlens.operators.statsjoin import join_stats
from ledgerlens.session import materialize, remove_path, scratch_path

# Fixed value: the amount cap used by the original cleaning job.
AMOUNT_CAP = 131.45

# Sentiment class ids of the review classifier.
LABELS = {0: "NEUTRAL", 1: "POSITIVE", 2: "NEGATIVE"}


def safe_cast(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cast columns, NULL where a value does not convert (instead of failing the job)."""
    return df.withColumns({c: F.trim(F.col(c).cast("string")).try_cast(t) for c, t in casts.items()})


def drop_incomplete(df: DataFrame, thresh: int = 2, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least ``thresh`` present values (NULL and NaN count as missing)."""
    return df.dropna(thresh=thresh, subset=list(subset) if subset else None)


def not_null_filter(df: DataFrame, cols: Sequence[str] = ("tx_amount", "tx_time_seconds")) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def cap_amount(df: DataFrame, cap: float | Column = AMOUNT_CAP, col: str = "tx_amount") -> DataFrame:
    """Values above the cap become the cap; NULL stays NULL."""
    capv = cap if isinstance(cap, Column) else F.lit(float(cap))
    return df.withColumn(col, F.when(F.col(col) > capv, capv).otherwise(F.col(col)))


def _residuals(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """``df`` with the fitted value, the residual and its sample standard deviation per group."""
    d = df.withColumn("_x", epoch_seconds(x).cast("double"))
    fit = d.groupBy(*by).agg(F.regr_slope(y, "_x").alias("_b"), F.regr_avgx(y, "_x").alias("_ax"),
                             F.regr_avgy(y, "_x").alias("_ay"))
    d = join_stats(d, fit, by)
    # prediction around the means: no large intercept to cancel against
    d = d.withColumn("_pred", F.col("_ay") + F.col("_b") * (F.col("_x") - F.col("_ax")))
    d = d.withColumn("_res", F.col(y) - F.col("_pred"))
    return join_stats(d, d.groupBy(*by).agg(F.stddev_samp("_res").alias("_sd")), by)


def time_outliers(df: DataFrame, n: float = 4.0, two_sided: bool = False, action: str = "replace",
                  by: Sequence[str] = ("source_file",), x: str = "tx_datetime",
                  y: str = "tx_time_seconds") -> DataFrame:
    """Regress ``y`` on the epoch seconds of ``x`` per group; repair or drop rows whose residual exceeds n·σ.

    One-sided (``residual > nσ``) is the original job; ``two_sided`` (``|residual| >= nσ``) is the
    notebook's rule.
    ``action='replace'`` puts the fitted value in ``y``; ``'drop'`` removes the row.
    σ is the sample standard deviation of the residuals; σ = 0 or unknown changes nothing,
    and a row without ``x`` or ``y`` is never an outlier.
    """
    if action not in ("replace", "drop"):
        raise ValueError("action must be 'replace' or 'drop'")
    d = _residuals(df, list(by), x, y)
    border = F.lit(n) * F.col("_sd")
    # one-sided as the job (residual > border); two-sided as the notebook, which kept |residual| < border
    beyond = (F.abs(F.col("_res")) >= border) if two_sided else (F.col("_res") > border)
    outlier = F.coalesce((F.col("_sd") > 0) & beyond, F.lit(False))
    if action == "replace":
        d = d.withColumn(y, F.when(outlier, F.col("_pred")).otherwise(F.col(y)))
    else:
        d = d.filter(~outlier)
    return d.drop("_x", "_b", "_ax", "_ay", "_pred", "_res", "_sd")


def outlier_flags(df: DataFrame, n: float = 4.0, by: Sequence[str] = ("source_file",), x: str = "tx_datetime",
                  y: str = "tx_time_seconds") -> DataFrame:
    """Residual, σ and the two-sided flag per row (the notebook's view of the same fit)."""
    d = _residuals(df, list(by), x, y).withColumnsRenamed({"_b": "slope", "_res": "residual", "_sd": "sigma"})
    beyond = F.abs("residual") >= F.lit(n) * F.col("sigma")
    return (d.withColumn("is_outlier", F.coalesce((F.col("sigma") > 0) & beyond, F.lit(False)))
             .drop("_x", "_ax", "_ay", "_pred"))


def _capped(df: DataFrame, cap: float | Column, by: Sequence[str] = ("source_file",)) -> DataFrame:
    return cap_amount(drop_incomplete(df, 2, [c for c in df.columns if c not in by]), cap)


def clean_transactions(df: DataFrame, cap: float | Column = AMOUNT_CAP, n: float = 4.0, two_sided: bool = False,
                       action: str = "replace", by: Sequence[str] = ("source_file",), stage: bool = True) -> DataFrame:
    """incomplete rows -> amount cap -> time outliers.

    The outlier step reads its input three times (fit, residual σ, output).  With ``stage`` (the
    default) the filtered, capped rows are written once as parquet under the shared checkpoint root, so
    an expensive input (text parsing) is computed once and the two statistics passes read only
    the three columns they use.
    """
    ready = _capped(df, cap, by)
    if stage:
        ready = materialize(ready, "clean_input")
    return time_outliers(ready, n=n, two_sided=two_sided, action=action, by=by)


def clean_files(spark, in_path: str, out_path: str, cap: float | Column = AMOUNT_CAP, n: float = 4.0,
                two_sided: bool = False, action: str = "replace", stage: bool = True) -> DataFrame:
    """The cleaning job end to end: raw text files -> typed -> cleaned -> one parquet folder per input file.

    With ``stage=True`` the text is parsed, filtered (incomplete rows) and capped once, and written
    as parquet under the shared checkpoint root; the two regression passes then read three of its
    columns and the final pass reads it whole - instead of parsing the text three times.
    Returns the written table.
    """
    from ledgerlens.sources.files import read_transactions, write_clean

    typed = read_transactions(spark, in_path)
    if not stage:
        write_clean(clean_transactions(typed, cap=cap, n=n, two_sided=two_sided, action=action, stage=False), out_path)
        return spark.read.parquet(out_path)
    staged = scratch_path(spark, "clean_input")
    _capped(typed, cap).write.parquet(staged)
    write_clean(time_outliers(spark.read.parquet(staged), n=n, two_sided=two_sided, action=action), out_path)
    remove_path(spark, staged)
    return spark.read.parquet(out_path)


def fix_datetime_report(lines: DataFrame, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Per file: body rows, unparseable datetimes, hour-24 rows repaired, total defects."""
    body = lines.filter(~F.col("value").startswith("#"))
    staged = body.select(*by, F.get(F.split("value", ","), 1).alias("_txt"))
    fixed = fix_datetime("_txt")
    return (staged.groupBy(*by)
                .agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(fixed.isNull()).alias("n_bad"),
                     F.count_if(fixed.isNotNull() & F.coalesce(is_hour_24("_txt"), F.lit(False))).alias("n_repaired"))
                .withColumn("n_defects", F.col("n_bad") + F.col("n_repaired")))


def select_rename_drop(df: DataFrame, keep: Sequence[str] | None = None, rename: dict[str, str] | None = None,
                       drop: Sequence[str] = (), constants: dict[str, object] | None = None) -> DataFrame:
    out = df.select(*keep) if keep else df
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    if drop:
        out = out.drop(*drop)
    for name, value in (constants or {}).items():
        out = out.withColumn(name, F.lit(value))
    return out


def filter_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows whose timestamp falls on ``day`` (a range predicate the scan can push down)."""
    start = F.to_timestamp_ntz(F.lit(day))
    return df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY")))


def coverage_check(df: DataFrame, wanted: str, by: str = "source", ts: str = "created_time") -> DataFrame:
    """Per source: the oldest row must precede ``wanted``, else more history has to be fetched."""
    return (df.groupBy(by).agg(F.min(ts).alias("oldest"), F.count(F.lit(1)).alias("n_rows"))
              .withColumn("covered", F.col("oldest") < F.to_timestamp_ntz(F.lit(wanted))))


def assert_covered(report: DataFrame) -> None:
    """Fail like the original ``assert``: one small aggregate, only a count reaches the driver."""
    missing = report.filter(~F.col("covered")).count()
    if missing:
        raise AssertionError(f"{missing} source(s) do not reach back far enough; fetch more history")


def map_labels(df: DataFrame, col: str, out: str = "sentiment", labels: dict[int, str] = LABELS) -> DataFrame:
    m = F.create_map(*[x for k, v in sorted(labels.items()) for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, m[F.col(col).cast("int")])


def array_to_columns(df: DataFrame, col: str, n: int, prefix: str = "X") -> DataFrame:
    """``X[i] -> X1..Xn``; an array that is too short gives NULL, not an error."""
    return df.withColumns({f"{prefix}{i + 1}": F.get(F.col(col), i) for i in range(n)})


TRAIN_SCHEMA = T.StructType([
    T.StructField("X", T.ArrayType(T.DoubleType())),
    T.StructField("y", T.FloatType()),
])


def parse_json(df: DataFrame, col: str = "value", schema: T.StructType = TRAIN_SCHEMA, out: str = "raw_data") -> DataFrame:
    """binary/string JSON -> struct by schema; malformed JSON gives a struct of NULLs."""
    return df.withColumn(out, F.from_json(F.col(col).cast("string"), schema))


def format_json(df: DataFrame, cols: Sequence[str], out: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(out))
