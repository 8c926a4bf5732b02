"""Work that is dealt by size, not by files, row groups or ranges."""

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlens.operators import subwords as S
from ledgerlens.session import materialize, spread
from ledgerlens.sources import ranges, serial


def test_spread_deals_one_part_to_all(spark):
    one = materialize(spark.range(0, 150_000, 1, 1).withColumn("t", F.sha2(F.col("id").cast("string"), 512)), "one")
    assert one.groupBy(F.spark_partition_id()).count().count() == 1  # one row group
    parts = materialize(spread(one), "even").groupBy(F.col("_metadata.file_path").alias("p")).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 150_000 and max(r["count"] for r in parts) < 100_000


def test_ranges_share_tasks(spark):
    """6 GB in ranges of 256 KB were 24,576 tasks, twice."""
    n = ranges.tasks_for(spark, (6 << 30) // (256 << 10), 6 << 30)
    assert 100 < n < 400
    assert ranges.tasks_for(spark, 3, 1000) == 3 and ranges.tasks_for(spark, None, None) == 1


def test_serial_ids_evaluate_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out = serial.with_serial_ids(spark.range(500).toDF("k").repartition(4).mapInArrow(count, "k long"), ["k"])
    assert [(r["id"], r["k"]) for r in out.orderBy("id").collect()] == [(i + 1, i) for i in range(500)]
    assert seen.value == 500


def test_pieces_of_a_batch_are_bounded(spark, monkeypatch):
    """A batch of many words is taken in pieces, with the same vectors."""
    df = spark.createDataFrame([(i, " ".join(f"w{i % 7}x{j}" for j in range(50))) for i in range(60)] + [(60, None)], "id int, content string")
    parameters = S.fit_subwords(df, dim=4, buckets=64, steps=1)
    column = pa.array([[f"a{i}b{j}" for j in range(50)] for i in range(60)] + [None])
    monkeypatch.setattr(S, "_WORDS", 200)
    pieces = list(S.text_chunks(column))
    assert sum(len(p[3]) for p in pieces) == 61 and max(int(p[3].sum()) for p in pieces) <= 200 and len(pieces) >= 15
    assert [p[1][k] for p in pieces for k in p[2]] == [w for t in column.to_pylist() if t for w in t]
    assert S.embed_subwords(df, parameters).count() == 61


def test_a_pass_of_the_fit_has_a_part_a_core(spark, monkeypatch):
    """Each part sends a gradient of the model's size, so their number must not follow the text's."""
    from ledgerlens.operators import ml as ML
    from ledgerlens.plans import text_ml_queries as Q

    class Fit:
        def fit(self, df):
            return df.rdd.getNumPartitions(), df.count()

    train = spark.range(400).select(F.col("id").cast("string").alias("content"), (F.col("id") % 3).cast("double").alias("label"), F.lit("train").alias("split"))
    monkeypatch.setattr(Q, "_labelled", lambda *_: train)
    monkeypatch.setattr(Q, "spread", lambda df: df.repartition(40))
    monkeypatch.setattr(ML, "sentiment_pipeline", Fit)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        parts, rows = Q.sentiment_model(spark, "")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts <= spark.sparkContext.defaultParallelism and rows == 400


def test_sentiment_words_equal_the_stepwise_form(spark):
    from ledgerlens.functions import text as T
    from ledgerlens.operators import ml as ML

    df = spark.createDataFrame([("The  Cat,cat-dog\tA\n b_c",), ("İstanbul ΣΑΣ №5 ½",), ("",), (" ,;",), ("a\u00a0b  𝒳𝔸 e\u0301",)], "content string")
    got = ML.sentiment_pipeline().getStages()[0].transform(df).select("_tokens", T.tokens(T.normalize_text("content")).alias("w")).collect()
    assert len(got) == 5 and all(r["_tokens"] == r["w"] for r in got)
