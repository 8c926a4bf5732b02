"""Evaluation operators on ties, three classes and months without missed fraud."""

import datetime as dt

import pytest

from ledgerlens.operators import evaluation as EV
from ledgerlens.operators import vector as V
from ledgerlens.sources import files


def test_best_run_has_one_winner_on_a_tie(spark):
    runs = spark.createDataFrame([("b", 1, 0.9), ("a", 1, 0.9), ("c", 0, 0.5), ("d", 2, None)], "run string, started int, metric double")
    got = {r["run"]: r["best_model"] for r in EV.best_run(runs, run="run").collect()}
    assert got == {"a": 1, "b": 0, "c": 0, "d": 0}


def test_class_balance_of_three_classes(spark):
    rows = [(c,) for c, n in ((0, 100), (1, 50), (2, 10)) for _ in range(n)]
    got = {r["c"]: r["n_upsampled"] for r in EV.class_balance(spark.createDataFrame(rows, "c int"), "c").collect()}
    assert got == {0: 100, 1: 100, 2: 100}


def test_month_without_missed_fraud_has_a_row(spark):
    rows = [(dt.datetime(2024, 1, 5), 1, 0, 10.0), (dt.datetime(2024, 2, 5), 1, 1, 20.0), (dt.datetime(2024, 3, 5), 0, 0, 5.0)]
    df = spark.createDataFrame(rows, "tx_datetime timestamp, tx_fraud int, prediction int, tx_amount double")
    got = {r["month"].month: (r["damage"], r["n_missed"]) for r in EV.monthly_damage(df).collect()}
    assert got == {1: (10.0, 1), 2: (0.0, 0), 3: (0.0, 0)}


def test_similarity_target_and_non_finite_rows(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, None), (6, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "id long, embeddings array<double>")
    assert all(r["distance"] is None for r in V.scalar_subquery(df, 99).collect()) and V.scalar_subquery(df, 99).count() == 6
    with pytest.raises(Exception, match="more than one row"):
        V.scalar_subquery(df.unionAll(df), 1).collect()
    q = spark.createDataFrame([(7, [0.0, 1.0])], "query_id long, embeddings array<double>")
    assert [r["id"] for r in V.similar_rows_batch(df, q, k=10).orderBy("rank").collect()] == [1, 2, 6]


def test_quoted_fields_keep_quotes_separators_and_line_breaks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('score,source,dates,count\n4.5,"a ""b"", c\nd",2024-01-01,3\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("source", T.StringType()),
                           T.StructField("dates", T.DateType()), T.StructField("count", T.IntegerType())])
    got = files.load_table_csv(spark, str(tmp_path), schema).collect()
    assert len(got) == 1 and got[0]["source"] == 'a "b", c\nd' and got[0]["count"] == 3


def test_poisson_draws_have_their_mean_and_variance(spark):
    from pyspark.sql import functions as F
    for mean in (0.7, 12.0, 60.0, 5000.0):
        u = (F.col("id") + 0.5) / 4000
        normal = F.sqrt(-2 * F.log(u)) * F.cos(6.283185307179586 * ((F.col("id") * 2503 % 4000) + 0.5) / 4000)
        r = spark.range(4000).select(EV.poisson_of(F.lit(mean), u, normal).alias("k")).agg(F.avg("k"), F.var_samp("k"), F.min("k")).first()
        assert r[0] == pytest.approx(mean, rel=0.02) and r[1] == pytest.approx(mean, rel=0.1) and r[2] >= 0


def test_cell_bootstrap_agrees_with_the_row_bootstrap(spark):
    from pyspark.sql import functions as F
    df = spark.range(4000).select("id", (F.col("id") % 10 == 0).cast("int").alias("tx_fraud"), (F.col("id") % 13 == 0).cast("int").alias("prediction"))
    rows, cells = (EV.bootstrap_ci(df, "id", 300).first(), EV.bootstrap_ci_cells(df, 300).first())
    assert all(abs(rows[c] - cells[c]) < 0.012 for c in rows.asDict()), (rows, cells)
    # the draws do not depend on how many rows there are: four cells a replicate
    more = df.unionAll(df).unionAll(df.withColumn("tx_fraud", F.lit(None).cast("int")))
    assert EV.bootstrap_cells(more, 50).count() == 50
    assert EV.bootstrap_ci_cells(df.where("false")).first()["fnr_lo"] is None
