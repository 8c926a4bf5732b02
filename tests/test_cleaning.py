"""Cleaning quirks: NULL handling, the amount cap, the outlier rule and its options."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import cleaning as C
from ledgerlens.sources.files import parse_transaction_lines


def _tx(spark, rows):
    schema = "tranaction_id bigint, tx_datetime timestamp_ntz, tx_amount double, tx_time_seconds double, source_file string"
    return spark.createDataFrame(rows, schema)


def test_drop_incomplete_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1, None, None), (2, float("nan"), None), (3, 1.0, None), (None, None, None)],
                               "a bigint, b double, c string")
    assert sorted(r.a for r in C.drop_incomplete(df, 2).collect()) == [3]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(1, 500.0), (2, None), (3, 10.0)], "id int, tx_amount double")
    got = {r.id: r.tx_amount for r in C.cap_amount(df).collect()}
    assert got == {1: 131.45, 2: None, 3: 10.0}


def _line(n, base=dt.datetime(2024, 1, 1)):
    rows = []
    for i in range(n):
        ts = base + dt.timedelta(hours=i)
        rows.append((i, ts, 1.0, float(i * 3600), "f"))
    return rows


def test_outliers_replaced_by_fit_one_sided(spark):
    rows = _line(200)
    rows[50] = (50, rows[50][1], 1.0, rows[50][3] + 1e9, "f")   # far above the line
    rows[60] = (60, rows[60][1], 1.0, rows[60][3] - 1e9, "f")   # far below: one-sided rule keeps it
    out = {r.tranaction_id: r.tx_time_seconds for r in C.time_outliers(_tx(spark, rows)).collect()}
    assert abs(out[50] - 50 * 3600) < 1e7          # replaced by the fitted value (fit pulled by both outliers)
    assert out[60] == rows[60][3]


def test_two_sided_drop(spark):
    rows = _line(200)
    rows[50] = (50, rows[50][1], 1.0, rows[50][3] + 1e9, "f")
    rows[60] = (60, rows[60][1], 1.0, rows[60][3] - 1e9, "f")
    out = C.time_outliers(_tx(spark, rows), two_sided=True, action="drop")
    ids = {r.tranaction_id for r in out.collect()}
    assert 50 not in ids and 60 not in ids and len(ids) == 198


def test_zero_sigma_changes_nothing(spark):
    rows = _line(20)
    out = C.time_outliers(_tx(spark, rows))
    assert sorted((r.tranaction_id, r.tx_time_seconds) for r in out.collect()) == [(r[0], r[3]) for r in rows]


def test_null_time_is_never_an_outlier(spark):
    rows = _line(50) + [(99, None, 1.0, 1e12, "f")]
    out = {r.tranaction_id: r.tx_time_seconds for r in C.time_outliers(_tx(spark, rows)).collect()}
    assert out[99] == 1e12


def test_global_fit_without_groups(spark):
    rows = _line(100)
    rows[10] = (10, rows[10][1], 1.0, rows[10][3] + 1e9, "f")
    out = {r.tranaction_id: r.tx_time_seconds for r in C.time_outliers(_tx(spark, rows), by=()).collect()}
    assert out[10] < 1e8


def test_fit_equals_mllib(spark):
    """The regr_* fit is ordinary least squares, the same line MLlib's LinearRegression finds."""
    from ledgerlens.functions.datetime import epoch_seconds
    from ledgerlens.operators.ml import linear_fit
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), 1.0, float(i * 420 + (i % 7) * 13), "f")
            for i in range(300)]
    df = _tx(spark, rows).withColumn("x", epoch_seconds("tx_datetime").cast("double"))
    m = linear_fit(df, ["x"], "tx_time_seconds")
    r = df.agg(F.regr_slope("tx_time_seconds", "x").alias("b")).first()
    assert abs(m.coefficients[0] - r.b) < 1e-6


def test_parse_lines_positions_and_blanks(spark):
    lines = spark.createDataFrame([("f", "# a | b"), ("f", "7,2024-01-02 24:00:05,3,4,,5,6,1,2"), ("f", "x1,,,,,,,,")],
                                  "source_file string, value string")
    rows = parse_transaction_lines(lines).orderBy("tx_time_days").collect()
    assert len(rows) == 2
    full = [r for r in rows if r.tranaction_id == 7][0]
    assert full.tx_datetime == dt.datetime(2024, 1, 3, 0, 0, 5) and full.tx_amount is None and full.tx_fraud == 1
    bad = [r for r in rows if r.tranaction_id is None][0]
    assert bad.tx_datetime is None


def test_map_labels_and_array_columns(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (2, [3.0])], "c int, X array<double>")
    out = C.array_to_columns(C.map_labels(df, "c"), "X", 3).orderBy("c").collect()
    assert [r.sentiment for r in out] == ["NEUTRAL", "NEGATIVE"]
    assert out[1].X2 is None and out[0].X3 is None


def test_samples_keep_about_the_fraction_per_day(spark):
    from ledgerlens.sources.files import random_sample, sample_rows
    df = spark.range(20000).withColumn("day", (F.col("id") % 10).cast("int"))
    for s in (sample_rows(df, "id", 0.1), random_sample(df, 0.1)):
        per_day = {r.day: r["count"] for r in s.groupBy("day").count().collect()}
        assert all(120 <= n <= 280 for n in per_day.values()) and len(per_day) == 10
    a = {r.id for r in sample_rows(df, "id", 0.1).collect()}
    b = {r.id for r in sample_rows(df, "id", 0.1).collect()}
    assert a == b  # deterministic


def test_read_transactions_plain_files_tagged_by_name(spark):
    import os
    from ledgerlens.session import scratch_path
    from ledgerlens.sources.files import read_transactions
    root = scratch_path(spark, "plain_files").replace("file:", "")
    os.makedirs(root, exist_ok=True)
    for name, body in (("2019-08-22.txt", "1,2019-08-22 10:00:00,5,6,7.5,100,0,0,0"),
                       ("2019-08-23.txt", "2,2019-08-23 24:00:00,5,6,1.25,200,1,1,2")):
        with open(os.path.join(root, name), "w") as fh:
            fh.write("# tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount | tx_time_seconds | "
                     "tx_time_days | tx_fraud | tx_fraud_scenario\n" + body + "\n")
    got = {r.source_file: (r.tranaction_id, r.tx_datetime) for r in read_transactions(spark, root).collect()}
    assert got == {"2019-08-22.txt": (1, dt.datetime(2019, 8, 22, 10)), "2019-08-23.txt": (2, dt.datetime(2019, 8, 24, 0))}


def test_write_clean_replaces_only_the_files_it_writes(spark):
    from ledgerlens.session import scratch_path
    from ledgerlens.sources.files import write_clean
    path = scratch_path(spark, "clean_out")
    day1 = spark.createDataFrame([(1, "a.txt"), (2, "b.txt")], "id int, source_file string")
    write_clean(day1, path)
    write_clean(spark.createDataFrame([(3, "b.txt")], "id int, source_file string"), path)
    got = sorted((r.source_file, r.id) for r in spark.read.parquet(path).collect())
    assert got == [("a.txt", 1), ("b.txt", 3)]


def test_load_table_csv_rating_and_vector_files(spark):
    import os
    from ledgerlens.session import scratch_path
    from ledgerlens.sources.files import RATING_SCHEMA, REVIEWS_SCHEMA, load_table_csv
    root = scratch_path(spark, "csv_in").replace("file:", "")
    os.makedirs(root + "/rating", exist_ok=True)
    os.makedirs(root + "/reviews", exist_ok=True)
    with open(root + "/rating/rating.csv", "w") as fh:   # header names differ from the table: columns are positional
        fh.write("score,source,dates,ratings\n,AppStore,2022-09-05,\n4.75,GooglePlay,2022-09-06,1200\n")
    with open(root + "/reviews/reviews.csv", "w") as fh:
        fh.write("content|score|created_time|country|source|sentiment|embeddings\n"
                 "good app|5|2023-01-02 10:00:00|ru|AppStore  |POSITIVE  |[0.5,-1.25,2.0]\n")
    r = {x.source: x for x in load_table_csv(spark, root + "/rating", RATING_SCHEMA).collect()}
    assert r["AppStore"].score is None and r["AppStore"]["count"] is None
    assert r["GooglePlay"].score == 4.75 and r["GooglePlay"]["count"] == 1200 and str(r["GooglePlay"].dates) == "2022-09-06"
    v = load_table_csv(spark, root + "/reviews", REVIEWS_SCHEMA, sep="|", vector_cols=("embeddings",)).first()
    assert v.embeddings == [0.5, -1.25, 2.0] and v.source == "AppStore" and v.sentiment == "POSITIVE"
    assert v.created_time == dt.datetime(2023, 1, 2, 10)


def test_many_groups_are_joined_by_salt_with_the_same_result(spark):
    from ledgerlens.operators.statsjoin import join_stats
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 40 as string)) AS g", "cast(id as double) AS v")
    stats = df.groupBy("g").agg(F.avg("v").alias("m"))
    few = join_stats(df, stats, ["g"])
    many = join_stats(df, stats, ["g"], broadcast_groups=3)
    assert many.count() == 3000 and few.exceptAll(many.select(few.columns)).count() == 0
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()


def test_stats_join_with_maps_and_null_groups(spark):
    from ledgerlens.operators.statsjoin import join_stats
    df = spark.range(40).selectExpr("nullif(id % 5, 0) AS g", "map('a', id) AS m", "id AS x", "array(map(1, id)) AS am")
    stats = df.groupBy("g").agg(F.sum("x").alias("total"))
    key = lambda d: sorted((str(r["g"]), r["x"], r["total"]) for r in d.collect())
    few, many = join_stats(df, stats, ["g"]), join_stats(df, stats, ["g"], broadcast_groups=3)
    assert key(few) == key(many) and few.columns == many.columns and few.where("total IS NULL").count() == 0
