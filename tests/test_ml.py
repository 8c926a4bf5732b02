"""Model outputs have no exact oracle; check their shape and invariants on the smallest data set."""

from pyspark.sql import functions as F

from ledgerlens.operators import evaluation as EV
from ledgerlens.operators.text import embed_text
from ledgerlens.sources import tables

SMOKE = "/root/testdata/sf0.001"


def test_embeddings_one_vector_per_review_same_text_same_vector(spark):
    docs = tables.docs(spark, SMOKE)
    out, model = embed_text(docs, dim=16, min_count=1)
    assert out.count() == docs.count()
    assert out.filter(F.size("embeddings") != 16).count() == 0
    same = out.groupBy("content").agg(F.countDistinct("embeddings").alias("n")).filter("n > 1").count()
    assert same == 0 and model.getVectors().count() > 0


def test_sentiment_labels_are_the_fixed_names(spark):
    import __spark_entry__ as E
    out = E.queries()["score_sentiment"](spark, SMOKE)
    names = {r.sentiment for r in out.select("sentiment").distinct().collect()}
    assert names <= {"NEUTRAL", "POSITIVE", "NEGATIVE"} and out.count() == tables.docs(spark, SMOKE).count()


def test_fraud_model_scores_exactly_the_hold_out(spark):
    import __spark_entry__ as E
    pred = E.queries()["train_fraud"](spark, SMOKE)
    held = EV.time_split(tables.tx(spark, SMOKE)).filter(F.col("split") == "test")
    assert pred.count() == held.count()
    assert {r.prediction for r in pred.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_fraud_model_report_is_consistent(spark):
    import __spark_entry__ as E
    r = E.queries()["fraud_model_rates"](spark, SMOKE).first()
    assert r.tp + r.fn + r.fp + r.tn > 0
    for lo, hi in ((r.fnr_lo, r.fnr_hi), (r.fpr_lo, r.fpr_hi)):
        assert lo is None or (0.0 <= lo <= hi <= 1.0)


def test_sentiment_recalls_held_out_classes(spark):
    import __spark_entry__ as E
    rows = E.queries()["sentiment_recall"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r["n_right"] for r in rows) > 0.6 * sum(r["n_held_out"] for r in rows)
