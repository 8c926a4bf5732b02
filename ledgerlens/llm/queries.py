"""Queries of the operators in this package: each applies one operator to its whole table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds DuckDB oracles where
SQL can express the result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import (conversation_repair, decontam, langid, lm_score, near_embed, ngram_join, periodic_runs, quality, secret_scan, sp_sample,
                            token_codes, token_counts, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


ROOT = str(Path(__file__).resolve().parents[2])


def query(name: str, sql: str | None = None):
    """Register a query; Python workers find this package where the driver does (or as installed)."""
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op8_decontamination", sql=r"""
WITH norm AS (
  SELECT doc_id AS id, 'd' AS kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT item_id, 'b', regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (SELECT id AS item_id, w, least(len(w), 10) AS m FROM norm WHERE kind = 'b' AND len(w) > 0),
windows AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS s
            FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM items)),
sizes AS (SELECT DISTINCT m FROM windows),
grams AS (SELECT id, p, m, array_to_string(w[p:p + m - 1], ' ') AS s
          FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS p
                FROM norm, sizes WHERE kind = 'd' AND len(w) >= m)),
hits AS (SELECT g.id, g.p, g.m, x.item_id FROM grams g JOIN windows x ON g.s = x.s AND g.m = x.m),
words AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + m)) AS q FROM hits) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY id)
SELECT n.id AS doc_id, CAST(len(n.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named.names, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AS contaminated
FROM norm n LEFT JOIN words ON words.id = n.id LEFT JOIN named ON named.id = n.id WHERE n.kind = 'd'
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents streamed through the automaton of all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.match(docs, table(spark, sf_dir, "benchmark"))
    return decontam.digest(found.drop("text")).drop("longest_match")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op3_token_codes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as directly addressable codes and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_codes.roundtrip(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False)


@query("op9_warc", sql="""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM f
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives with segmented records and read back."""
    found = warc.roundtrip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_lm_score")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the backoff automaton learned from four fifths of them."""
    return lm_score.score(table(spark, sf_dir, "documents"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and decision of every document under the model of trusted text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.judge(docs, table(spark, sf_dir, "labels"))


@query("op7_langid")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, learned from three quarters of them."""
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


@query("op5_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole document: base rules and the network's findings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.scan(docs).drop("text"))


@query("op6_near_embed", sql="""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.vec_id, CAST((SELECT count(*) FROM pairs WHERE pairs.a = c.vec_id) AS BIGINT) AS n_links, c.component_id,
       c.vec_id = c.component_id AS kept FROM comp c
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label."""
    return near_embed.link(table(spark, sf_dir, "embeddings"))


@query("op1_ngram_join", sql=r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM words WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT c.a, c.b FROM common c JOIN size x ON x.doc_id = c.a JOIN size y ON y.doc_id = c.b
          WHERE c.n * 10 >= 8 * (x.n + y.n - c.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT c.doc_id, c.class_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.doc_id = c.class_id AS kept
FROM comp c LEFT JOIN degree d ON d.doc_id = c.doc_id
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy groups and link counts of all documents."""
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_sp_sample")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every whole document, with ids and inclusion scores."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sp_sample.sample(docs, tokenizer_path("piece_bpe_32k.model"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all whole documents, a tenth of them with planted repeats."""
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.plant(table(spark, sf_dir, "documents"))))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repairs of all conversations after planted damage."""
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damage(conversations), conversations)


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under the byte-level vocabulary."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
