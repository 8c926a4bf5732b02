"""Profiling operators on hand-made inputs: box plot numbers, histogram edges, rollup totals,
datetime domain, value shares and percentiles (numpy's linear interpolation)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile as P


def test_box_stats_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = spark.createDataFrame([("f", v) for v in vals] + [("f", None)], "source_file string, tx_amount double")
    r = P.box_stats(df).first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (r.q1, r.median, r.q3) == (q1, med, q3)
    assert r.whisker_low == 1.0 and r.whisker_high == 8.0 and r.n_outliers == 1


def test_histogram_last_bin_holds_the_max(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("f", base + dt.timedelta(seconds=s)) for s in (0, 10, 50, 99, 100)]
    df = spark.createDataFrame(rows, "source_file string, tx_datetime timestamp_ntz")
    h = {r.bin: r.n for r in P.histogram(df, bins=10).collect()}
    counts, _ = np.histogram([0, 10, 50, 99, 100], bins=10)
    assert [h.get(i + 1, 0) for i in range(10)] == list(counts)


def test_column_profile_totals_and_null_file(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, 2.0), (None, 3, float("nan"))],
                               "source_file string, x int, y double")
    got = {(r.source_file, r.column_name): (r.nrows, r.na) for r in P.column_profile(df).collect()}
    assert got[("a", "x")] == (2, 1) and got[("a", "y")] == (2, 1)
    assert got[(None, "y")] == (1, 1)                 # a NULL file name is its own group
    assert got[("*", "x")] == (3, 1) and got[("*", "y")] == (3, 2)


def test_datetime_domain_and_bad_values(spark):
    lines = spark.createDataFrame(
        [("f", "# a | b"), ("f", "1,2024-01-05 24:10:00"), ("f", "2,2023-12-31 07:00:59"), ("f", "3,23"),
         ("f", "4,2024-02-30 10:00:00")], "source_file string, value string")
    dom = {r.part: r for r in P.datetime_domain(lines).collect()}
    assert dom["year"].distinct_values == "2023,2024" and dom["hour"].max_value == 24
    assert dom["year"].n_bad == 1                       # '23' does not have the layout
    bad = {r.text for r in P.datetime_bad_values(lines).collect()}
    assert bad == {"23", "2024-02-30 10:00:00"}         # layout ok but impossible date counts as bad too


def test_value_share_and_daily_percentiles(spark):
    rows = [("f", dt.datetime(2024, 1, 1, h), float(h), 1.0, s) for h, s in zip(range(10), [0, 0, 1, 1, 1, 2, 0, 0, 0, 0])]
    df = spark.createDataFrame(rows, "source_file string, tx_datetime timestamp_ntz, tx_amount double, "
                                     "tx_time_seconds double, scen int")
    share = {r.scen: r.share for r in P.value_share(df, "scen").collect()}
    assert share == {0: 0.6, 1: 0.3, 2: 0.1}
    d = P.daily_percentiles(df).first()
    assert [d.amount_lower, d.amount_median, d.amount_higher] == list(np.percentile(np.arange(10.0), [5, 50, 95]))


def test_schema_drift_reports_renamed_column(spark):
    lines = spark.createDataFrame(
        [("f1", "# id | amount"), ("f1", "1,2.5"), ("f1", "2,"), ("f2", "# ident | amount"), ("f2", "x,3")],
        "source_file string, value string")
    got = {r.column_name: (r.dtypes, r.n_files, r.absent_in) for r in P.schema_drift(lines, 2).collect()}
    assert got == {"id": ("int64", 1, "f2"), "ident": ("object", 1, "f1"), "amount": ("float64,int64", 2, "")}


def test_box_stats_equals_numpy_on_odd_shapes(spark):
    rng = np.random.default_rng(5)
    shapes = {"one": [7.0], "two": [1.0, 2.0], "same": [3.0] * 9, "wide": list(rng.lognormal(3, 3, 4001)), "neg": list(rng.normal(0, 1e6, 1000)),
              "inf": [float("-inf"), 1.0, 2.0, 3.0, float("inf")]}
    rows = [(k, float(v)) for k, vs in shapes.items() for v in vs] + [("none", None)]
    got = {r.source_file: r for r in P.box_stats(spark.createDataFrame(rows, "source_file string, tx_amount double")).collect()}
    assert set(got) == set(shapes)
    for k, vs in shapes.items():
        # by rank; numpy multiplies infinity by a weight of 0
        q = np.array([1.0, 2.0, 3.0]) if k == "inf" else np.percentile(vs, [25, 50, 75])
        assert np.allclose([got[k].q1, got[k].median, got[k].q3], q, rtol=1e-12)
        lo, hi = q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])
        inside = [v for v in vs if lo <= v <= hi]
        assert (got[k].whisker_low, got[k].whisker_high, got[k].n_outliers) == (min(inside), max(inside), len(vs) - len(inside))


def test_null_file_is_a_file(spark):
    rows = [(None, float(i), i) for i in range(9)] + [("a", float(i % 4), i) for i in range(8)] + [(None, None, 3)]
    df = spark.createDataFrame(rows, "source_file string, tx_amount double, s int").selectExpr(
        "*", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS tx_datetime")
    got = {r["source_file"]: tuple(r)[1:] for r in P.box_stats(df).collect()}
    assert got == {None: (2.0, 4.0, 6.0, 0.0, 8.0, 0), "a": (0.75, 1.5, 2.25, 0.0, 3.0, 0)}
    bins = {}
    for r in P.histogram(df, bins=3).collect():
        bins.setdefault(r["source_file"], {})[r["bin"]] = r["n"]
    assert sum(bins[None].values()) == 10 and sum(bins["a"].values()) == 8


def test_an_outlier_does_not_put_all_others_in_one_part(spark):
    """Quartiles of one file with many values and one far outlier: the parts hold like shares, and the result is exact."""
    x = np.random.default_rng(2).normal(size=20_000).round(4)
    x[0] = 1e9
    df = spark.createDataFrame([("a", float(v)) for v in x], "source_file string, tx_amount double")
    r = P.box_stats(df).first()
    assert [r["q1"], r["median"], r["q3"]] == pytest.approx(np.percentile(x, [25, 50, 75]).tolist(), abs=1e-12)
    seen = []
    join = P.join_stats
    def watched(a, b, by, **kw):
        out = join(a, b, by, **kw)
        if "_cuts" in out.columns:
            seen.append(out.select(F.size(F.filter("_cuts", lambda c: c < F.col("tx_amount"))).alias("p")).groupBy("p").count().agg(F.max("count"), F.count("*")).first())
        return out
    P.join_stats = watched
    try:
        P.box_stats(df).count()
    finally:
        P.join_stats = join
    assert seen[0][0] < 0.03 * len(np.unique(x)) and seen[0][1] > 100
