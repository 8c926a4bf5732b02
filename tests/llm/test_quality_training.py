"""op2's model counts every trusted document."""

from pyspark.sql import functions as F

from ledgerlens.llm import quality


def test_model_counts_all_trusted_documents(spark):
    """More documents of one language than any earlier bound, each with n-grams of its own."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.format_string("%05x", "id").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    trained = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0).collect()
    assert len(trained) > 22_000
    want = set()
    for r in trained:
        raw = bytes([quality.PAD]) * 3 + r["text"].encode()
        want |= {int.from_bytes(raw[i:i + 4], "big") for i in range(len(r["text"]))}
    got = {r["g"] for r in quality.train(docs, labels).where("k = 4").collect()}
    assert got == want
