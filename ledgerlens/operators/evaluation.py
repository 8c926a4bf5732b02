"""Model evaluation on DataFrames: error rates, monthly damage, bootstrap
intervals, best-run selection, class balance and hold-out split.

Randomness comes from md5 of row keys (``functions.hashing``), so every number here is
reproducible and checkable in SQL.  The bootstrap draws four replicates from one md5 and
sums the Poisson(1) weights into confusion cells by a partial aggregate in the same stage, so
the shuffle carries replicates x 4 numbers per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions.hashing import key_hash, poisson1_of, unit_hash
from ledgerlens.operators.statsjoin import join_stats

# The business targets of the fraud project.
FNR_TARGET = 0.02
FPR_TARGET = 0.05
MONTHLY_DAMAGE_LIMIT = 500_000


def _cells(label: str, pred: str, w=None):
    w = F.lit(1) if w is None else w
    y, p = F.col(label), F.col(pred)
    return [F.sum(F.when((y == 1) & (p == 1), w).otherwise(0)).alias("tp"),
            F.sum(F.when((y == 0) & (p == 1), w).otherwise(0)).alias("fp"),
            F.sum(F.when((y == 0) & (p == 0), w).otherwise(0)).alias("tn"),
            F.sum(F.when((y == 1) & (p == 0), w).otherwise(0)).alias("fn")]


def _rates(df: DataFrame) -> DataFrame:
    fnr = F.col("fn") / F.when((F.col("fn") + F.col("tp")) > 0, F.col("fn") + F.col("tp"))
    fpr = F.col("fp") / F.when((F.col("fp") + F.col("tn")) > 0, F.col("fp") + F.col("tn"))
    return df.withColumn("fnr", fnr).withColumn("fpr", fpr)


def fraud_metrics(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction") -> DataFrame:
    """FN, TP, FP, TN in one pass; FNR = FN/(FN+TP) and FPR = FP/(FP+TN) with pass flags."""
    m = _rates(df.agg(*_cells(label, pred)))
    return m.withColumn("fnr_ok", F.col("fnr") < FNR_TARGET).withColumn("fpr_ok", F.col("fpr") < FPR_TARGET)


def monthly_damage(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction", amount: str = "tx_amount",
                   ts: str = "tx_datetime", limit: float = MONTHLY_DAMAGE_LIMIT) -> DataFrame:
    """Per month with transactions: total amount of missed frauds (0 without any), and whether it stays under the limit."""
    missed = (F.col(label) == 1) & (F.col(pred) == 0)
    g = df.filter(F.col(ts).isNotNull()).groupBy(F.trunc(F.to_date(ts), "month").alias("month")).agg(
        F.coalesce(F.sum(F.when(missed, F.col(amount))), F.lit(0.0)).alias("damage"), F.count_if(missed).alias("n_missed"))
    return g.withColumn("within_limit", F.col("damage") <= F.lit(limit))


def bootstrap_ci(df: DataFrame, key: str, replicates: int = 200, label: str = "tx_fraud", pred: str = "prediction",
                 lo: float = 0.025, hi: float = 0.975) -> DataFrame:
    """Percentile interval of FNR and FPR over Poisson(1) bootstrap replicates keyed by md5(key, replicate)."""
    n_blocks = (replicates + 3) // 4
    # the md5 comes out of the generator as a column of its own, so the four sums do not compute it again
    digests = F.transform(F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda b: key_hash(key, b))
    drawn = df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull()).select(
        F.col(label).alias("_y"), F.col(pred).alias("_p"), F.posexplode(digests).alias("_blk", "_h"))
    cells = drawn.groupBy("_blk", "_y", "_p").agg(*[F.sum(poisson1_of("_h", j)).alias(f"_w{j}") for j in range(4)])
    reps = cells.select("_y", "_p", F.explode(F.array(*[
        F.struct((F.col("_blk") * 4 + j).alias("rep"), F.col(f"_w{j}").alias("w")) for j in range(4)])).alias("_r"))
    reps = reps.select("_y", "_p", "_r.rep", "_r.w").filter(F.col("rep") < replicates)
    per_rep = _rates(reps.groupBy("rep").agg(*_cells("_y", "_p", F.col("w"))))
    return per_rep.agg(F.percentile("fnr", [lo, hi]).alias("_f"), F.percentile("fpr", [lo, hi]).alias("_p")).select(
        F.col("_f")[0].alias("fnr_lo"), F.col("_f")[1].alias("fnr_hi"),
        F.col("_p")[0].alias("fpr_lo"), F.col("_p")[1].alias("fpr_hi"))


# Below this a cell's draw walks the distribution; above it, a normal draw is rounded (its error is far below the draw's own).
_EXACT_MEAN = 60


def poisson_of(mean, unit, normal) -> Column:
    """A Poisson draw with the given mean: inverse distribution at ``unit`` for small means, else the rounded ``normal`` draw.

    The sum of n independent Poisson(1) weights is Poisson(n), so one draw stands for n rows.
    """
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(4 * _EXACT_MEAN)),
        F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("c")),
        lambda a, i: F.when(unit >= a["c"], F.struct(i.alias("k"), (a["p"] * mean / i).alias("p"), (a["c"] + a["p"] * mean / i).alias("c"))).otherwise(a),
        lambda a: a["k"])
    return F.when(mean <= _EXACT_MEAN, walk).otherwise(F.greatest(F.round(mean + F.sqrt(mean) * normal), F.lit(0.0))).cast("long")


def bootstrap_cells(df: DataFrame, replicates: int = 200, label: str = "tx_fraud", pred: str = "prediction", seed: int = 1) -> DataFrame:
    """Weights of the four confusion cells in every replicate: (rep, tp, fp, tn, fn).

    The rates depend on the rows only through the cells' counts, so each cell is drawn once per replicate, Poisson(count),
    instead of once per row: the cost after one count of the rows is 4 x ``replicates`` draws, whatever their number.
    Numbers come from md5(seed, replicate, cell).
    """
    cells = df.where(F.col(label).isin(0, 1) & F.col(pred).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y"), F.col(pred).cast("int").alias("p")).agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    drawn = cells.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    h = key_hash(F.lit(seed), F.col("rep"), F.col("y"), F.col("p"))
    unit = lambda at: (F.conv(F.substring(h, at, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    normal = F.sqrt(-2 * F.log(unit(9))) * F.cos(2 * math.pi * unit(17))
    drawn = drawn.withColumn("w", poisson_of(F.col("n"), unit(1), normal))
    return drawn.groupBy("rep").agg(*_cells("y", "p", F.col("w")))


def bootstrap_ci_cells(df: DataFrame, replicates: int = 200, label: str = "tx_fraud", pred: str = "prediction", lo: float = 0.025, hi: float = 0.975,
                       seed: int = 1) -> DataFrame:
    """``bootstrap_ci`` from the confusion cells alone; rows without a label or prediction take no part."""
    per_rep = _rates(bootstrap_cells(df, replicates, label, pred, seed))
    return per_rep.agg(F.percentile("fnr", [lo, hi]).alias("_f"), F.percentile("fpr", [lo, hi]).alias("_p")).select(
        F.col("_f")[0].alias("fnr_lo"), F.col("_f")[1].alias("fnr_hi"), F.col("_p")[0].alias("fpr_lo"), F.col("_p")[1].alias("fpr_hi"))


def best_run(runs: DataFrame, metric: str = "metric", started: str = "started", run: str | None = None) -> DataFrame:
    """``best_model = 1`` for exactly one run: the earliest to reach the highest metric.

    ``run`` names the run id (default: ``started``, then unique); among runs with equal metric and
    start the smallest id wins.

    A run only takes the title by beating the holder, so among equal metrics the earliest wins.
    The holder is found by ``orderBy(metric desc, started).limit(1)`` (each task keeps its best
    row; no single-partition window) and that one row is broadcast back as the flag.
    """
    run = run or started
    holder = (runs.filter(F.col(metric).isNotNull()).orderBy(F.col(metric).desc(), F.col(started), F.col(run))
                  .limit(1).select(F.col(run).alias("_holder")))
    j = runs.join(F.broadcast(holder), F.col(run) == F.col("_holder"), "left")
    return j.withColumn("best_model", F.when(F.col("_holder").isNotNull(), 1).otherwise(0)).drop("_holder")


def class_balance(df: DataFrame, label: str = "tx_fraud") -> DataFrame:
    """Class counts, the ratio of the largest to each class, and the counts after upsampling each to about 1:1."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    j = counts.crossJoin(F.broadcast(counts.agg(F.max("n").alias("_max"))))  # one row
    factor = F.round(F.col("_max") / F.col("n")).cast("int")
    return j.select(label, "n", (F.col("_max") / F.col("n")).alias("ratio"), factor.alias("factor"),
                    (F.col("n") * factor).alias("n_upsampled"))


def upsample(df: DataFrame, balance: DataFrame, label: str = "tx_fraud") -> DataFrame:
    """Repeat each minority row ``factor`` times (``explode(sequence)``).

    The factor table has one row per class.
    """
    j = join_stats(df.filter(F.col(label).isNotNull()), balance.select(label, "factor"), [label], "inner")
    return j.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("factor")))).drop("_copy", "factor")


def time_split(df: DataFrame, day: str = "tx_time_days", test_fraction: float = 0.2) -> DataFrame:
    """Hold-out of the newest days: the smallest share of whole days with at least ``test_fraction`` of the rows.

    A model that looks back must not be tested on days it was trained on.  Rows without a day are training rows.
    """
    per_day = df.filter(F.col(day).isNotNull()).groupBy(F.col(day).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    newest = Window.orderBy(F.col("_d").desc())  # one row per day
    cum = per_day.select("_d", F.sum("_n").over(newest).alias("_cum"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    first = cum.filter(F.col("_cum") >= F.col("_all") * F.lit(test_fraction)).agg(F.max("_d").alias("_first"))
    return df.crossJoin(F.broadcast(first)).withColumn(
        "split", F.when(F.col(day) >= F.col("_first"), "test").otherwise("train")).drop("_first")


def train_test_split(df: DataFrame, key: str, test_fraction: float = 0.2) -> DataFrame:
    """Hold-out by md5 of the key: the same row is always in the same part."""
    return df.withColumn("split", F.when(unit_hash(key) < F.lit(test_fraction), "test").otherwise("train"))
