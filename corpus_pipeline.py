"""The corpus pipeline: documents -> sampled token ids, in five stages.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and calls one operator of ``ledgerlens.llm``;
all but the last return the columns of ``documents``.  ``run`` writes each result as Parquet below
the shared checkpoint folder and reads it again as the next stage's ``docs``, so a lost executor
recomputes at most one stage.

1. quality: documents above their language's perplexity threshold go.
2. near_copies: one document of every group of near copies stays (the smallest doc_id).
3. benchmark: spans that occur in benchmark items are cut; documents made of them go.
4. secrets: found secrets are replaced by a mark.
5. tokens: two distinct sampled segmentations per document, with inclusion scores.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontam, ngram_join, quality, secret_scan, sp_sample
from ledgerlens.llm.queries import ROOT, table, tokenizer_path
from ledgerlens.session import materialize

ORACLE_SQL = None  # perplexity, network and sampling have no SQL form; tests/llm has brute-force versions


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def sample_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp_sample.sample(docs, tokenizer_path("piece_bpe_32k.model"))


def _stage(fn):
    """Python workers import the package from where the driver does."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return fn(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, _stage(fn)) for name, fn in (("quality", keep_good), ("near_copies", drop_near_copies), ("benchmark", cut_benchmark),
                                              ("secrets", mask_secrets), ("tokens", sample_tokens))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
