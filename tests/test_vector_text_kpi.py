"""Nearest neighbours against numpy brute force, dedup, text normalisation, KPI gaps."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.functions.text import normalize_text, remove_stopwords
from ledgerlens.operators import kpi as K
from ledgerlens.operators.text import boolean_search_batch, dedup_content
from ledgerlens.operators.vector import similar_rows, similar_rows_batch


def _vectors(spark, n=300, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[7] = x[3]      # exact tie between rows 3 and 7
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    return x, spark.createDataFrame(rows, "id long, embeddings array<float>").repartition(4)


def test_similar_rows_self_first_and_matches_numpy(spark):
    x, df = _vectors(spark)
    got = similar_rows(df, 3, k=20).collect()
    d = np.sqrt(((x.astype(np.float64) - x[3].astype(np.float64)) ** 2).sum(axis=1))
    want = sorted(range(len(x)), key=lambda i: (d[i], i))[:20]
    assert [r.id for r in got] == want
    assert got[0].distance == 0.0 and got[1].id == 7


def test_similar_rows_batch_matches_brute_force(spark):
    x, df = _vectors(spark)
    qs = df.filter(F.col("id") < 15).select(F.col("id").alias("query_id"), "embeddings")
    got = similar_rows_batch(df, qs, k=5).collect()
    xd = x.astype(np.float64)
    for q in range(15):
        d = np.sqrt(((xd - xd[q]) ** 2).sum(axis=1))
        want = sorted(range(len(x)), key=lambda i: (d[i], i))[:5]
        mine = [r.id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        assert mine == want


def test_dedup_first_source_wins(spark):
    df = spark.createDataFrame([(1, "same", 2, "b"), (2, "same", 1, "a"), (3, "same", 1, "c"), (4, "other", 5, "d")],
                               "id long, content string, source_rank int, source string")
    out = {r.content: (r.id, r.n_copies) for r in dedup_content(df).collect()}
    assert out == {"same": (2, 3), "other": (4, 1)}


def test_normalize_keeps_cyrillic_and_drops_stopwords(spark):
    df = spark.createDataFrame([("Товар — СУПЕР!!  the  best_one, de la",)], "t string")
    r = df.select(normalize_text("t").alias("n")).select("n", remove_stopwords("n").alias("c")).first()
    assert r.n == "товар супер the best_one de la"
    assert r.c == "товар супер best_one"


def test_batch_search_counts(spark):
    df = spark.createDataFrame([("a b",), ("b",), ("c",)], "content string")
    got = {r.query: r.n_rows for r in boolean_search_batch(df, ["a", "b", "NOT b", ""]).collect()}
    assert got == {"a": 1, "b": 2, "NOT b": 1, "": 3}


def test_day_over_day_gap_gives_null(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 1), 3.0), (dt.date(2024, 1, 2), 4.0), (dt.date(2024, 1, 4), 2.0)],
                              "dt date, v double")
    got = {r.dt.day: (r.change, r.sign) for r in K.day_over_day(d, "v").collect()}
    assert got == {1: (None, None), 2: (1.0, "+"), 4: (None, None)}


def test_weighted_rating_from_star_map(spark):
    rv = spark.createDataFrame([("s", 5)] * 3 + [("s", 1)], "source string, score int")
    r = K.weighted_rating(K.star_histogram(rv)).first()
    assert r["score"] == 4.0 and r["count"] == 4


def test_round_half_up_on_decimal_reading(spark):
    r = spark.range(1).select(K.round_half_up(F.lit(2.675)).alias("a"), K.pct(F.lit(0.285)).alias("b")).first()
    assert r.a == 2.68 and r.b == 29


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_dedup_combines_copies_before_the_shuffle(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"t{i}", i % 5, "s") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, content string, source_rank int, source string").repartition(8)
    plan = _plan(dedup_content(df))
    assert "partial_min" in plan and "Window" not in plan


def test_profile_scans_once(spark):
    from ledgerlens.operators.profile import column_profile
    df = spark.range(1000).selectExpr("cast(id % 4 as string) as source_file", "id", "cast(null as double) as x")
    plan = _plan(column_profile(df))
    assert plan.count("Range (") == 1 and "Expand" not in plan


def test_sentiment_tokens_match_the_dataframe_normalisation(spark):
    from ledgerlens.functions.text import tokens
    from ledgerlens.operators.ml import sentiment_pipeline
    df = spark.createDataFrame([("Hello, World! Товар — супер_1  ok", 1.0)], "content string, label double")
    tok = sentiment_pipeline().getStages()[0]
    got = tok.transform(df).first()["_tokens"]
    want = df.select(tokens(normalize_text("content")).alias("t")).first().t
    assert got == want == ["hello", "world", "товар", "супер_1", "ok"]


def test_star_histogram_skips_missing_scores(spark):
    rv = spark.createDataFrame([("s", 5), ("s", None), ("s", 3)], "source string, score int")
    r = K.weighted_rating(K.star_histogram(rv)).first()
    assert r["score"] == 4.0 and r["count"] == 2


def test_similar_rows_batch_exact_with_many_ties(spark):
    """Far more than 2k rows share the k-th distance: the k smallest ids among them must win."""
    x = np.zeros((400, 4), dtype=np.float32)
    x[:, 0] = 1.0
    x[0] = 0.0                       # the query row itself; every other row is at distance 1
    rows = [(i, [float(v) for v in x[i]]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, embeddings array<float>").repartition(3)
    qs = df.filter(F.col("id") == 0).select(F.col("id").alias("query_id"), "embeddings")
    got = [r.id for r in sorted(similar_rows_batch(df, qs, k=5).collect(), key=lambda r: r.rank)]
    assert got == [0, 1, 2, 3, 4]
