"""Registered queries for partial reads, split loads, serial ids, review ingest and the approximate text and vector forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import ingest as I
from ledgerlens.operators import ivf
from ledgerlens.operators import ml as ML
from ledgerlens.operators import subwords as S
from ledgerlens.operators import vector as V
from ledgerlens.plans.cleaning_queries import VEC_SUM_SQL, vec_sum
from ledgerlens.plans.registry import register
from ledgerlens.plans.sqlfixtures import with_views
from ledgerlens.plans.text_ml_queries import _DIST_SQL, _WORDS_SQL, sentiment_model
from ledgerlens.session import materialize, scratch_path, spread
from ledgerlens.sources import files, ranges, serial, tables

# ------------------------------------------------------------------ 2.1 sources

PREFIX_BYTES = 8192
FILE_EVENTS = 5000  # events a text file of the prefix check holds

_PREFIX_SQL = with_views("tx_lines") + rf""",
o AS (SELECT source_file AS f, value, CAST(regexp_extract(value, '^x?(\d+)', 1) AS BIGINT) AS ord FROM tx_lines WHERE NOT starts_with(value, '#')),
l AS (SELECT replace(f, '.txt', '') || '_' || (ord // {FILE_EVENTS}) || '.txt' AS source_file, ord, value FROM o),
h AS (SELECT DISTINCT source_file, -1 AS ord, '{tables.header_line(False)}' AS value FROM l),
a AS (SELECT *, sum(strlen(value) + 1) OVER (PARTITION BY source_file ORDER BY ord) AS upto FROM (SELECT * FROM l UNION ALL SELECT * FROM h)),
p AS (SELECT source_file, string_split(value, ',') AS f FROM a WHERE upto <= {PREFIX_BYTES} AND ord >= 0)
SELECT source_file, TRY_CAST(trim(f[1]) AS BIGINT) AS tranaction_id, TRY_CAST(trim(f[3]) AS BIGINT) AS customer_id,
       TRY_CAST(trim(f[5]) AS DOUBLE) AS tx_amount FROM p"""


@register("sample_prefix", "2.1", sql=_PREFIX_SQL)
def q_sample_prefix(spark, sf_dir):
    """The transactions in the first 8 KB of every raw text file; no more is read of it."""
    body = tables.tx_lines_from_events(spark, sf_dir).where(~F.col("value").startswith("#"))
    body = body.withColumn("ord", F.regexp_extract("value", r"^x?(\d+)", 1).cast("long"))
    tag = F.concat(F.regexp_replace("source_file", r"\.txt$", ""), F.lit("_"), F.floor(F.col("ord") / FILE_EVENTS).cast("string"), F.lit(".txt"))
    body = body.select(tag.alias("source_file"), "ord", "value")
    heads = body.select("source_file").distinct().select("source_file", F.lit(-1).cast("long").alias("ord"), F.lit(tables.header_line(False)).alias("value"))
    path = scratch_path(spark, "tx_files")
    (body.unionByName(heads).repartition("source_file").sortWithinPartitions("source_file", "ord").drop("ord")
         .write.partitionBy("source_file").text(path))
    rows = files.parse_transaction_lines(ranges.prefix_lines(spark, path, PREFIX_BYTES))
    return rows.select("source_file", "tranaction_id", "customer_id", "tx_amount")


_REVIEWS_SQL = """
SELECT id, nullif(content, '') AS content, CAST(id % 5 + 1 AS INTEGER) AS score, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(id) AS created_time,
       country, source, ['NEUTRAL', 'POSITIVE', 'NEGATIVE'][CAST(id % 3 + 1 AS INTEGER)] AS sentiment, [CAST(id % 7 AS FLOAT), 0.5] AS embeddings FROM docs"""


@register("load_reviews_split", "2.1", sql=with_views("docs") + f""",
r AS ({_REVIEWS_SQL})
SELECT row_number() OVER (ORDER BY created_time) AS id, content, score, created_time, country, source, sentiment, {VEC_SUM_SQL} AS vec_sum FROM r""")
def q_load_reviews_split(spark, sf_dir):
    """Whole reviews with times and vectors in quoted text, each file read by a task for every 256 KB, numbered by time on load."""
    path = scratch_path(spark, "reviews_csv")
    d = tables.docs(spark, sf_dir).select(
        "content", (F.col("id") % 5 + 1).cast("int").alias("score"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int))").alias("created_time"),
        "country", F.rpad("source", 20, " ").alias("source"),
        F.element_at(F.array(F.lit("NEUTRAL"), F.lit("POSITIVE"), F.lit("NEGATIVE")), (F.col("id") % 3 + 1).cast("int")).alias("sentiment"),
        F.array((F.col("id") % 7).cast("float"), F.lit(0.5).cast("float")).alias("embeddings"))
    files.write_table_csv(d, path, sep="|", vector_cols=("embeddings",))
    r = files.load_table_csv(spark, path, files.REVIEWS_SCHEMA, sep="|", vector_cols=("embeddings",), split_bytes=256 << 10)
    out = serial.with_serial_ids(r, ["created_time"])
    return out.select("id", "content", "score", "created_time", "country", "source", "sentiment", vec_sum(F.col("embeddings")).alias("vec_sum"))


@register("serial_ids", "2.1", sql=with_views("rv") + f"""
SELECT row_number() OVER (ORDER BY batch_id, review_id) AS id, review_id, score, batch_id
FROM (SELECT id AS review_id, score, CAST(CASE WHEN source = '{tables.SOURCES[0]}' THEN 1 ELSE 2 END AS INTEGER) AS batch_id FROM rv)""")
def q_serial_ids(spark, sf_dir):
    """Two loads into one table, the first of them run again: ids 1..n without gaps."""
    path = scratch_path(spark, "serial_reviews")
    rows = tables.rv(spark, sf_dir).select(F.col("id").alias("review_id"), "score", "source")
    for batch, source in ((1, tables.SOURCES[0]), (2, tables.SOURCES[1]), (1, tables.SOURCES[0])):
        serial.append_serial(rows.where(F.col("source") == source).drop("source"), path, batch, ["review_id"])
    return spark.read.parquet(path).select("id", "review_id", "score", F.col("batch_id").cast("int").alias("batch_id"))


INGEST_START = "2024-03-01"
_DAYS = tuple(f"2024-03-0{i}" for i in (1, 2, 3))


@register("ingest_reviews", "2.6", sql=with_views("docs") + f""",
t AS (SELECT *, id % 3 AS d, id % 2 AS r FROM docs WHERE content IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY content, d ORDER BY r, id) AS rn, count(*) OVER (PARTITION BY content, d) AS n_copies,
             min(d) OVER (PARTITION BY content) AS first_d FROM t)
SELECT id, CAST(CAST(DATE '{INGEST_START}' + CAST(d AS INTEGER) AS DATE) AS VARCHAR) AS day, sha256(content) AS sha, n_copies, TRUE AS has_sentiment, 16 AS dims
FROM n WHERE rn = 1 AND d = first_d""")
def q_ingest_reviews(spark, sf_dir):
    """Three days of reviews loaded day by day, the second of them twice: copies within and across days stored once, each with
    its sentiment and its vector."""
    docs = tables.docs(spark, sf_dir)
    model = sentiment_model(spark, sf_dir)
    parameters = S.fit_subwords(docs, dim=16, buckets=1 << 12, steps=2)  # one step moves contexts only
    rows = docs.select("id", "content", F.expr(f"timestamp_ntz'{INGEST_START} 06:00:00' + make_dt_interval(cast(id % 3 as int))").alias("created_time"),
                       (F.col("id") % 2).cast("int").alias("source_rank"))
    frames = [(rows.where(F.col("source_rank") == i), {"source": s}) for i, s in enumerate(tables.SOURCES)]
    store = scratch_path(spark, "review_store")
    steps = [lambda df: ML.score_sentiment(model, df), lambda df: S.embed_subwords(df, parameters)]
    for day in (*_DAYS[:2], *_DAYS[1:]):
        I.ingest_day(spark, frames, store, day, steps)
    out = spark.read.parquet(f"{store}/reviews")
    return out.select("id", F.col("day").cast("string").alias("day"), "sha", "n_copies", F.col("sentiment_id").isin(0, 1, 2).alias("has_sentiment"),
                      F.size("embeddings").alias("dims"))


# ------------------------------------------------------------------ 2.7 text and vectors

@register("embed_subwords", "2.7", sql=with_views("docs") + f"""
SELECT id, 32 AS dims, len({_WORDS_SQL}) = 0 AS is_zero, TRUE AS same_as_equal_text FROM docs""")
def q_embed_subwords(spark, sf_dir):
    """Sub-word vectors of all reviews, by what is certain of them: their length, which are zero, and equal texts' equality."""
    out = materialize(_subword_vectors(spark, sf_dir), "subword_vectors")
    digest, vec = F.sha2(F.coalesce("content", F.lit("")), 256), F.xxhash64("embeddings")
    same = out.groupBy(digest.alias("_sha")).agg((F.min(vec) == F.max(vec)).alias("same_as_equal_text"))
    return (out.withColumn("_sha", digest).join(same, "_sha")
               .select("id", F.size("embeddings").alias("dims"), F.forall("embeddings", lambda v: v == 0).alias("is_zero"), "same_as_equal_text"))


@register("embed_subwords_vectors", "2.7")
def q_embed_subwords_vectors(spark, sf_dir):
    """The sub-word vectors themselves."""
    return _subword_vectors(spark, sf_dir).select("id", "embeddings")


def _subword_vectors(spark, sf_dir):
    docs = spread(tables.docs(spark, sf_dir).select("id", "content"))
    docs = materialize(docs.withColumn("words", S.words_of("content")), "subword_docs")
    return S.embed_subwords(docs, S.fit_subwords(docs, "words", dim=32, buckets=1 << 13, steps=2), "words")


def _asked(emb):
    return emb.where(F.col("id") % 50 == 0).select(F.col("id").alias("query_id"), "embeddings")


@register("similar_rows_ivf", "2.7", sql=with_views("emb") + f""",
q AS (SELECT id AS query_id, embeddings FROM emb WHERE id % 50 = 0),
d AS (SELECT q.query_id, e.id, {_DIST_SQL.replace('t.embeddings', 'q.embeddings')} AS dist FROM q, emb e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS rank FROM d)
SELECT query_id, id, round(dist, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def q_similar_rows_ivf(spark, sf_dir):
    """10 nearest rows of every fiftieth row through the inverted-file index with all its lists probed, which is exact."""
    emb = tables.emb(spark, sf_dir)
    index = ivf.build(emb, lists=16)
    return ivf.search(index, _asked(emb), k=10, probes=index.lists).select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


@register("similar_rows_ivf_recall", "2.7", sql="SELECT count(*) AS n_queries, TRUE AS recall_ok FROM embeddings WHERE vec_id % 50 = 0")
def q_similar_rows_ivf_recall(spark, sf_dir):
    """Whether half of the lists hold at least nine tenths of the true 10 nearest rows of every fiftieth row."""
    emb = tables.emb(spark, sf_dir)
    index = ivf.build(emb, lists=16)
    true = V.similar_rows_batch(emb, _asked(emb), k=10).select("query_id", "id")
    found = ivf.search(index, _asked(emb), k=10, probes=8).select("query_id", "id", F.lit(1).alias("hit"))
    both = true.join(found, ["query_id", "id"], "left")
    return both.agg(F.count_distinct("query_id").alias("n_queries"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_ok"))
