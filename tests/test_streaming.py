"""Streaming: the file-source stream equals the batch computation; replayed batches do not duplicate."""

import os

from pyspark.sql import functions as F

from ledgerlens.session import scratch_path
from ledgerlens.streaming import jobs as S

SMOKE = "/root/testdata/sf0.001"


def test_landed_stream_equals_batch(spark):
    streamed = S.stream_sink_append(spark, SMOKE).drop("batch_id")
    batch = S.stream_features(S.train_records(spark.read.parquet(f"{SMOKE}/events.parquet"))).drop("features")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_idempotent_append_on_replay(spark):
    path = scratch_path(spark, "replay")
    w = S.idempotent_append(path)
    df = spark.range(10)
    w(df, 0)
    w(df, 0)          # the same batch again after a failure
    w(df, 1)
    assert spark.read.parquet(path).count() == 20


def test_daily_kpi_is_the_same_from_one_batch_or_many_and_after_a_restart(spark):
    o = spark.read.parquet(f"{SMOKE}/orders.parquet").select(*S.ORDERS_SCHEMA.names)
    want = {r["dt"]: (r["n"], r["s"]) for r in o.groupBy(F.to_date("o_orderdate").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.substring("o_orderpriority", 1, 1).cast("int")).alias("s")).collect()}
    folder = scratch_path(spark, "orders")
    for i in range(6):  # rows at random, so that late days are in every file
        o.where(F.pmod(F.hash("o_orderkey"), F.lit(6)) == i).coalesce(1).write.parquet(f"{folder}/{i}")
    def kpi(**kw):
        got = S.stream_daily_kpi(spark, f"{folder}/*", max_files=1, glob="*.parquet", **kw)
        return {r["dt"]: (r["n_reviews"], r["avg_score"]) for r in got.collect()}
    assert {k: v[0] for k, v in kpi().items()} == {k: v[0] for k, v in want.items()}
    root = scratch_path(spark, "kpi")
    first = kpi(root=root)
    assert first == kpi(root=root)  # a restart finds nothing new and repeats nothing
    assert all(abs(first[d][1] - want[d][1]) < 1e-9 for d in want)


def test_daily_sums_are_folded_and_a_replayed_fold_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "FOLD", 4)
    path = scratch_path(spark, "sums")
    write = S.daily_sums(path)
    rows = [[("2024-01-0%d" % (1 + (i + j) % 5), 1 + (i * j) % 5 if j else None, (i + j) % 2) for j in range(4)] for i in range(11)]
    frames = [spark.createDataFrame(r, "d string, score int, neg int").selectExpr("cast(d as date) dt", "score", "neg") for r in rows]
    for n, f in enumerate(frames[:8]):
        write(f, n)
    write(frames[7], 7)  # the folding batch once more, as after a failure
    write(frames[7], 7)
    for n, f in enumerate(frames[8:], 8):
        write(f, n)
    write(frames[10], 10)
    got = S.read_daily_sums(spark, path)
    folders = {f.rsplit("/", 2)[1] for f in got.inputFiles()}
    assert folders == {"upto_id=7", "batch_id=8", "batch_id=9", "batch_id=10"}
    total = {}
    for d, score, neg in (r for batch in rows for r in batch):
        s, n, g, m = total.get(d, (0, 0, 0, 0))
        total[d] = (s + (score or 0), n + (score is not None), g + neg, m + 1)
    sums = got.groupBy("dt").agg(*[F.sum(c) for c in ("score", "n_scores", "neg", "n_reviews")]).collect()
    assert {str(r[0]): tuple(r[1:]) for r in sums} == total
    assert S.read_daily_sums(spark, path, before=0) is None


def test_train_then_score_holds_out(spark):
    model, out = S.stream_train_then_score(spark, SMOKE)
    preds = spark.read.text(out)
    assert preds.count() > 0 and os.path.basename(out) == "data"
    assert [round(c, 4) for c in model.coefficients] == [0.5, 0.3333, 1.0]


def test_malformed_messages_are_landed_and_a_restart_repeats_nothing(spark):
    folder, root = scratch_path(spark, "messages"), scratch_path(spark, "restart")
    good = S.train_records(spark.read.parquet(f"{SMOKE}/events.parquet"), relation=True)
    bad = spark.createDataFrame([(10**9, "0", "{not json"), (10**9 + 1, "1", '{"X": [1.0], "y": 2.0}')],
                                "event_id long, key string, value string").selectExpr("event_id", "cast(key as binary) key", "cast(value as binary) value")
    def run(**kw):
        stream = spark.readStream.schema(good.schema).parquet(f"{folder}/*")
        return S.stream_train_then_score(spark, SMOKE, root=root, source=stream)
    good.filter("event_id % 2 = 0").union(bad).write.parquet(f"{folder}/a")
    run()
    good.filter("event_id % 2 = 1").write.parquet(f"{folder}/b")
    run()
    _, out = run()
    landed = spark.read.parquet(f"{root}/train/data")
    assert landed.count() == good.count() + 2 and landed.select("event_id").distinct().count() == good.count() + 2
    from ledgerlens.functions.hashing import unit_hash
    assert spark.read.text(out).count() == good.filter(unit_hash("event_id") < 0.2).count()
