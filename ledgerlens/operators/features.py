"""Trailing time-window features per card and per terminal.

A window ``[t - a days, t - b days)`` per key is the textbook
``count(*) OVER (PARTITION BY key ORDER BY t RANGE ...)``, but that puts every row of a
key in one task - and one card or terminal may hold a third of all rows.  We split the
window exactly along time buckets (one hour by default; any size that divides a day).
With B the bucket of t and k buckets per day:

* bucket ``B - a·k`` from the time of t within its bucket onwards,
* the whole buckets ``B - a·k + 1 .. B - b·k - 1``,
* bucket ``B - b·k`` before the time of t within its bucket.

The partial buckets come from one window partitioned by ``(key, bucket)``: each row meets
copies of the rows of buckets ``B - a·k`` and ``B - b·k`` shifted forward by a and b days,
and counts the copies ordered before it.  The whole buckets come from a
``(key, bucket)`` aggregate (one row per key and bucket) summed over a bucket range.
A hot key is therefore spread over as many tasks as it has active buckets, and the result
is exact.  Rows without a timestamp get NULL features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlens.functions.datetime import DAY_MICROS, epoch_micros

WindowSpec = tuple[str, int, int]  # (name, a_days, b_days): rows in [t - a days, t - b days)


def trailing_stats(df: DataFrame, key: str, ts: str, specs: Sequence[WindowSpec],
                   values: Sequence[str] = (), bucket_minutes: int = 60) -> DataFrame:
    """Add ``{name}_cnt`` and ``{name}_sum_{v}`` for every window spec; exactly 0 when the window is empty.

    Rows without a key or a time take part in no window and get NULL features.  A window that holds
    a NaN or infinite value sums to NaN, and only that window: such values are counted beside the
    running totals, not added to them.
    """
    for name, a, b in specs:
        if not (a > b >= 0):
            raise ValueError(f"window {name}: need a > b >= 0")
    if (24 * 60) % bucket_minutes:
        raise ValueError("bucket_minutes must divide one day")
    k = (24 * 60) // bucket_minutes          # buckets per day
    bucket_us = bucket_minutes * 60_000_000
    base = df.withColumn("_t", epoch_micros(ts)).withColumn("_bkt", F.floor(F.col("_t") / F.lit(bucket_us)).cast("long"))
    # rows without key or time would share one window: they go around it
    placed = F.col(key).isNotNull() & F.col("_t").isNotNull()
    aside, base = base.filter(~placed).drop("_t", "_bkt"), base.filter(placed)
    floating = [v for v in values if isinstance(df.schema[v].dataType, (T.DoubleType, T.FloatType))]
    kept = {v: f"_keep_{v}" for v in floating}
    for v in floating:
        odd = F.isnan(v) | (F.abs(v) == float("inf"))
        base = (base.withColumn(f"_odd_{v}", F.when(odd, 1).otherwise(0).cast("long"))
                    .withColumn(kept[v], F.col(v)).withColumn(v, F.when(~odd, F.col(v))))
    vcols = [*values, *(f"_odd_{v}" for v in floating)]
    shifts = sorted({a for _, a, _ in specs} | {b for _, _, b in specs if b > 0})

    slim = base.select(key, "_bkt", "_t", *vcols)
    # every row once for its own bucket and once for each shift, from one reading of the source; the
    # shifted copies carry the key, the time and the values only
    role = F.explode(F.array(*[F.lit(s).cast("long") for s in (0, *shifts)]))
    moved = base.withColumn("_role", role)
    needed = {key, "_bkt", "_t", "_role", *vcols}
    u = moved.select(key, "_role", *vcols, (F.col("_bkt") + F.col("_role") * k).alias("_bkt"), (F.col("_t") + F.col("_role") * DAY_MICROS).alias("_t"),
                     *(F.when(F.col("_role") == 0, F.col(c)).alias(c) for c in base.columns if c not in needed)).select(*base.columns, "_role")

    # an empty frame sums to NULL: every windowed sum is coalesced to 0
    w_before = Window.partitionBy(key, "_bkt").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(key, "_bkt")
    roles = sorted({0} | set(shifts))
    cols = {}
    for s in roles:
        is_s = F.col("_role") == s
        cols[f"_bc{s}"] = F.coalesce(F.sum(F.when(is_s, 1).otherwise(0)).over(w_before), F.lit(0))
        for v in vcols:
            cols[f"_bs{s}_{v}"] = F.coalesce(F.sum(F.when(is_s & F.col(v).isNotNull(), F.col(v)).otherwise(0)).over(w_before), F.lit(0))
        if s in {a for _, a, _ in specs}:
            cols[f"_tc{s}"] = F.sum(F.when(is_s, 1).otherwise(0)).over(w_all)
            for v in vcols:
                cols[f"_ts{s}_{v}"] = F.sum(F.when(is_s & F.col(v).isNotNull(), F.col(v)).otherwise(0)).over(w_all)
    u = u.withColumns(cols).filter(F.col("_role") == 0)

    # whole buckets between the two partial buckets, from the per-(key, bucket) table
    daily = slim.groupBy(key, "_bkt").agg(F.count(F.lit(1)).alias("_dc"),
                                          *[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(f"_ds_{v}") for v in vcols])
    full_cols = {}
    for name, a, b in specs:
        if (a - b) * k >= 2:
            # buckets in [B - a·k + 1, B - b·k - 1] = running total up to B - b·k - 1 minus up to B - a·k;
            # unbounded-preceding frames are evaluated incrementally (a sliding range frame is not)
            upto_hi = Window.partitionBy(key).orderBy("_bkt").rangeBetween(Window.unboundedPreceding, -(b * k + 1))
            upto_lo = Window.partitionBy(key).orderBy("_bkt").rangeBetween(Window.unboundedPreceding, -(a * k))
            for src, dst in [("_dc", f"_fc_{name}")] + [(f"_ds_{v}", f"_fs_{name}_{v}") for v in vcols]:
                full_cols[dst] = (F.coalesce(F.sum(src).over(upto_hi), F.lit(0))
                                  - F.coalesce(F.sum(src).over(upto_lo), F.lit(0)))
    if full_cols:
        daily = daily.withColumns(full_cols).drop("_dc", *[f"_ds_{v}" for v in vcols])
        u = u.join(daily, [key, "_bkt"], "left")

    out = {}
    for name, a, b in specs:
        cnt = F.col(f"_tc{a}") - F.col(f"_bc{a}") + F.col(f"_bc{b}")
        if (a - b) * k >= 2:
            cnt = cnt + F.coalesce(F.col(f"_fc_{name}"), F.lit(0))
        out[f"{name}_cnt"] = cnt.cast("long")
        for v in vcols:
            sm = F.col(f"_ts{a}_{v}") - F.col(f"_bs{a}_{v}") + F.col(f"_bs{b}_{v}")
            if (a - b) * k >= 2:
                sm = sm + F.coalesce(F.col(f"_fs_{name}_{v}"), F.lit(0))
            out[f"{name}_sum_{v}"] = F.when(cnt > 0, sm).otherwise(F.lit(0).cast(df.schema[v].dataType) if v in values else F.lit(0))
    u = u.withColumns(out)
    for name, _, _ in specs:
        for v in floating:
            u = u.withColumn(f"{name}_sum_{v}", F.when(F.col(f"{name}_sum__odd_{v}") > 0, F.lit(float("nan"))).otherwise(F.col(f"{name}_sum_{v}")))
            u = u.drop(f"{name}_sum__odd_{v}")
    for v in floating:
        u = u.withColumn(v, F.col(kept[v]))
    drop = [c for c in u.columns if c.startswith("_") and c not in df.columns]
    return u.drop(*drop).unionByName(aside, allowMissingColumns=True)


def customer_windows(tx: DataFrame, days: Sequence[int] = (1, 7, 30), key: str = "customer_id",
                     ts: str = "tx_datetime", amount: str = "tx_amount", bucket_minutes: int = 60) -> DataFrame:
    """Per card: number and total amount of its earlier transactions in the last 1, 7 and 30 days (0 if none),
    and the mean amount (NULL if none - see ``impute``)."""
    specs = [(f"c{d}d", d, 0) for d in days]
    out = trailing_stats(tx, key, ts, specs, [amount], bucket_minutes)
    for name, _, _ in specs:
        out = out.withColumn(f"{name}_avg", F.col(f"{name}_sum_{amount}") / F.when(F.col(f"{name}_cnt") > 0,
                                                                                 F.col(f"{name}_cnt")))
    return out


def terminal_risk(tx: DataFrame, window_days: int = 7, delay_days: int = 7, key: str = "terminal_id",
                  ts: str = "tx_datetime", label: str = "tx_fraud", bucket_minutes: int = 60) -> DataFrame:
    """Per terminal: transactions and frauds in ``[t - delay - window, t - delay)`` and their ratio.

    The delay leaves out the days whose fraud labels would not be known yet at time t
    (without it the feature leaks the target).
    """
    name = f"t{window_days}d"
    out = trailing_stats(tx, key, ts, [(name, delay_days + window_days, delay_days)], [label], bucket_minutes)
    cnt, fr = F.col(f"{name}_cnt"), F.col(f"{name}_sum_{label}")
    return out.withColumn(f"{name}_risk", F.when(cnt > 0, fr / cnt).otherwise(F.when(cnt.isNotNull(), F.lit(0.0))))


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Fill missing values with the column mean (first model version) or with 0 (second version).

    The means are one aggregate row, cross-joined by broadcast.
    """
    if strategy == "zero":
        return df.fillna(0, subset=list(cols))
    if strategy != "mean":
        raise ValueError("strategy must be 'mean' or 'zero'")
    means = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(means))
    return j.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in cols}).drop(*[f"_m_{c}" for c in cols])
