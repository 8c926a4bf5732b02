"""Review ingest over several days."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import ingest as I
from ledgerlens.session import scratch_path

DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]
TEXTS = {0: ["a", "b", "b", "c", None], 1: ["b", "d", "e"], 2: ["a", "e", "f", "f"]}


def frame(spark, days=(0, 1, 2), shift=0):
    rows = [(100 * d + i + shift, t, dt.datetime(2024, 3, d + 1, 8 + i), i % 2) for d in days for i, t in enumerate(TEXTS[d])]
    rows.append((999, "z", None, 0))
    return spark.createDataFrame(rows, "id long, content string, created_time timestamp_ntz, source_rank int")


def stored(spark, store):
    t = spark.read.parquet(f"{store}/reviews")
    return sorted((str(r["day"]), r["content"], r["id"], r["country"], r["n_copies"]) for r in t.collect())


WANT = [(DAYS[0], "a", 0, "ru", 1), (DAYS[0], "b", 2, "ru", 2), (DAYS[0], "c", 3, "ru", 1), (DAYS[1], "d", 101, "ru", 1), (DAYS[1], "e", 102, "ru", 1), (DAYS[2], "f", 202, "ru", 2)]


def test_three_days_and_a_second_run(spark):
    store = scratch_path(spark, "store")
    load = lambda d: I.ingest_day(spark, [(frame(spark), {"country": "ru"})], store, d, bits=1 << 16)
    read = [load(d) for d in DAYS]
    assert stored(spark, store) == WANT
    assert read == [[], DAYS[:1], DAYS[:2]]
    for d in (DAYS[1], DAYS[0], DAYS[2]):
        load(d)
        assert stored(spark, store) == WANT


def test_only_days_that_may_hold_a_text_are_read(spark):
    store = scratch_path(spark, "store")
    for i in range(6):
        rows = spark.range(50).select((F.col("id") + 1000 * i).alias("id"), F.concat(F.lit(f"text {i} "), F.col("id").cast("string")).alias("content"),
                                      F.lit(dt.datetime(2024, 1, i + 1, 5)).cast("timestamp_ntz").alias("created_time"), F.lit(0).alias("source_rank"))
        if i == 5:
            rows = rows.union(rows.limit(1).withColumn("content", F.lit("text 2 7")).withColumn("id", F.lit(1).cast("long")))
        read = I.ingest_day(spark, [(rows, {})], store, f"2024-01-0{i + 1}")
        assert read == ([] if i < 5 else ["2024-01-03"])
    assert spark.read.parquet(f"{store}/reviews").count() == 300


def test_a_filter_has_no_false_negatives(spark):
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("sha"))
    filters = I.build_filter(rows, 1 << 15).withColumn("day", F.lit("d"))
    assert filters.count() == 1 and I.may_hold(rows, filters, 1 << 15).count() == 3000
    other = spark.range(10_000, 13_000).select(F.sha2(F.col("id").cast("string"), 256).alias("sha"))
    assert I.may_hold(other, filters, 1 << 15).count() < 150  # about (1 - e^(-12000/32768))^4 of them


def test_a_full_filter_only_reads_more(spark):
    store = scratch_path(spark, "store")
    for d in DAYS:
        I.ingest_day(spark, [(frame(spark), {"country": "ru"})], store, d, bits=8)
    assert stored(spark, store) == WANT


def test_steps_see_only_kept_texts_and_empty_days(spark):
    store, seen = scratch_path(spark, "store"), []
    def step(df):
        seen.append(df.count())
        return df.withColumn("sentiment", F.lit("POSITIVE"))
    for d in [*DAYS, "2024-04-01"]:
        I.ingest_day(spark, [(frame(spark), {"country": "ru"})], store, d, [step], bits=1 << 16)
    assert seen == [3, 2, 1, 0] and stored(spark, store) == WANT


def test_training_moves_the_stored_vectors(spark, monkeypatch):
    """Contexts begin at zero: with one step of training the ingest's vectors were those of untrained parameters."""
    from conftest import SMOKE
    from ledgerlens.operators import subwords as S
    from ledgerlens.plans import load_queries as Q

    class Seen(Exception):
        pass

    def first_day(spark, frames, store, day, steps):
        rows = frames[0][0].limit(20).select("id", "content")
        untrained = S.embed_subwords(rows, S.initial_parameters(spark, 1 << 12, 16, 42))
        vectors = [{r["id"]: r["embeddings"] for r in df.collect()} for df in (steps[1](rows), untrained)]
        assert len(vectors[0]) == 20 and all(vectors[0][i] != v for i, v in vectors[1].items())
        raise Seen

    monkeypatch.setattr(Q, "sentiment_model", lambda *_: None)
    monkeypatch.setattr(I, "ingest_day", first_day)
    try:
        Q.q_ingest_reviews(spark, SMOKE)
        raise AssertionError("no day was loaded")
    except Seen:
        pass
