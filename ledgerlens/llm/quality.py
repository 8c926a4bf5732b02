"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one byte n-gram model (order ``ORDER``) per language, trained on documents labelled
good (quality 1, not toxic).  All counts, continuation counts, counts of counts, discounts and
context totals are DataFrame aggregations and joins keyed by (language, n-gram).  A document is
rejected when its perplexity exceeds its language's threshold: the ``quantile`` of the perplexities of
trusted documents that were not trained on.  Short texts vary more, so the quantile is one of
log perplexities in units of ``sqrt(a + b / n_bytes)``, with ``a`` and ``b`` from medians of the same documents.
Repeated words are nearly as probable as clean text, so a document is also rejected when more of its bytes
repeat a byte 4-gram of the ``NEAR`` bytes before them than in the ``repeats`` quantile of the same documents.

Sharded count joins: each bucket of documents asks hash shards for its distinct n-grams of every
order, the shards join them with the model's n-grams and answer with the two numbers an n-gram has
(its discounted probability, and its backoff weight as a context); then the bucket's documents
are scored.  See ``shards``; the model is never broadcast.  A group is one shard of the model and the buckets of one
region of documents (``REGION_ROWS``, and in proportion more where a larger model has more than ``SHARDS`` shards), so
groups keep their size and rows exchanged are linear in the documents; the model (at most all byte n-grams) is repeated
per region.  Only a document's place, id and scores come out of the
groups; ``keep_good`` and ``classify`` join them to the documents by file and row.

Nothing is drawn by chance: the model counts every trusted document of the training fold, and thresholds come from every
held-out trusted document.  Their ids are staged and joined, so no task or driver has to hold them.

Defined results: null or empty text: perplexity null, kept.  A null language is a language of its
own.  A language's limit is raised towards that of all languages, where that is higher, with the
weight of ``PRIOR`` calibration documents; one without any takes the limit of all languages.  Without any calibration document at all everything is kept.  Where documents are
too few to hold the quantile (under 100 for 0.99), the tail goes on from the greatest value as an exponential one of
the mean distance.  Very long texts are scored whole, in buckets of their own; a value equal to its limit is accepted.
Repeated rows are judged alike; an empty table gives none.  Extra columns pass through, whatever their names, in
``keep_good``; in ``classify`` those called ``perplexity``, ``threshold`` and ``accepted`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import shards as sh
from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

ORDER = 4
PAD = 10  # texts are read as if they began with line ends
NEAR = 64  # bytes in which a 4-gram comes again in repeated words
PRIOR = 5.0  # calibration documents that the limit of all languages weighs as many as
SHARDS = 128  # at least; a shard holds SHARD_KEYS n-grams of the model at most
SHARD_KEYS = 1 << 19
REGION_ROWS = 1 << 18  # documents of a region when the model has SHARDS shards
#: rows of a file that share a bucket, by the size of their texts (a bucket's texts are scored in pieces of 24 MB)
BUCKETS = ((64 << 10, 2048), (1 << 20, 64))


def language_hash(lang: str | None) -> np.uint64:
    raw = np.frombuffer(b"?" if lang is None else b"=" + lang.encode(), np.uint8)
    return tk.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def keys_of(codes: np.ndarray, k: int, lang: np.uint64) -> np.ndarray:
    """Shard keys of ``k``-grams of one language."""
    return tk.mix64(codes * tk.U64(0x9FB21C651E98DF25) + tk.U64((k + 1) * int(lang) % (1 << 64)))


def _trusted(docs: DataFrame, labels: DataFrame, fold: str, limit: int | None = None) -> DataFrame:
    """Labelled good documents of one fold: all (as training and calibration use them), or about ``limit`` of every language.

    The fold goes by the id alone, so only its documents meet the labels.
    """
    fold_of = lambda df: df.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0 if fold == "calibrate" else F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0)
    own = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")  # the hash depends on the type
    good = fold_of(labels.select(own, "quality", "toxic")).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    ids = good.where((F.col("q") == 1) & (F.coalesce("t", F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id")
    if limit is None:  # staged ids have a known size: few are broadcast, many are joined by sorting
        return fold_of(docs).join(materialize(ids, f"kn_{fold}_ids"), "doc_id", "left_semi")
    named = materialize(fold_of(docs).select("doc_id", "lang").join(ids, "doc_id", "left_semi").distinct(), f"kn_{fold}_ids")
    share = named.groupBy(F.col("lang").alias("l")).agg((F.lit(limit) / F.count(F.lit(1))).alias("share"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(fold)), F.lit(1 << 31)) < F.col("share") * (1 << 31)
    named = named.join(F.broadcast(share), F.col("lang").eqNullSafe(F.col("l"))).where(held).select(F.col("doc_id").alias("_id"), "l")
    return docs.join(F.broadcast(named), (F.col("doc_id") == F.col("_id")) & F.col("lang").eqNullSafe(F.col("l")), "left_semi")


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, g, c): counts of the full-order n-grams of texts, pre-aggregated per batch."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            langs = np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), object)
            buf, offs = tk.utf8(batch.column(batch.schema.get_field_index("text")))
            for code, rows in tk.gram_blocks(buf, offs, order, PAD, 4 << 20):
                for lang in set(langs[rows[0]:rows[-1] + 1]):
                    g, c = np.unique(code[(langs == lang)[rows]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)),
                                                      pa.array(c, pa.int64())], ["lang", "g", "c"])

    return (docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(step, "lang string, g long, c long")
                .groupBy("lang", "g").agg(F.sum("c").alias("c")))


def kneser_ney(grams: DataFrame, order: int) -> DataFrame:
    """(lang, k, g, a, gamma) from full-order counts: interpolated modified Kneser-Ney.

    ``a`` is the discounted probability of the n-gram's last byte; ``gamma`` the weight of the
    lower order after the n-gram as a context (k = 0: the empty context).
    """
    out = None
    for k in range(order, 0, -1):
        if k < order:  # continuation count: how many different bytes stand before the n-gram
            grams = grams.groupBy("lang", F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        grams = materialize(grams, f"kn_{k}")
        n = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        least = lambda d, top: F.coalesce(F.least(F.greatest(d, F.lit(0.1)), F.lit(top)), F.lit(0.5))
        ratio = lambda i: F.when(F.col(f"n{i}") > 0, F.col(f"n{i + 1}") / F.col(f"n{i}"))
        discount = (grams.groupBy("lang").agg(*n)
                         .withColumn("y", F.when(F.col("n1") > 0, y))
                         .select(F.col("lang").alias("l"), least(1 - 2 * F.col("y") * ratio(1), 1.0).alias("d1"),
                                 least(2 - 3 * F.col("y") * ratio(2), 2.0).alias("d2"), least(3 - 4 * F.col("y") * ratio(3), 3.0).alias("d3")))
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = F.least(cut, F.col("c").cast("double"))
        cutted = grams.join(discount, F.col("lang").eqNullSafe(F.col("l"))).withColumn("cut", cut).withColumn("h", F.shiftright("g", 8))
        context = cutted.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("cut").alias("freed"))
        seen = (cutted.alias("x").join(context.alias("y"), F.col("x.lang").eqNullSafe(F.col("y.lang")) & (F.col("x.h") == F.col("y.h")))
                      .select("x.lang", F.lit(k).alias("k"), "x.g", ((F.col("c") - F.col("cut")) / F.col("total")).alias("a"), F.lit(None).cast("double").alias("gamma")))
        free = context.select("lang", F.lit(k - 1).alias("k"), F.col("h").alias("g"), F.lit(None).cast("double").alias("a"),
                              (F.col("freed") / F.col("total")).alias("gamma"))
        part = materialize(seen.unionByName(free), f"kn_part_{k}")  # a plan per order: the driver plans and broadcasts little at a time
        out = part if out is None else out.unionByName(part)
    return (out.groupBy("lang", "k", "g").agg(F.coalesce(F.max("a"), F.lit(0.0)).alias("a"), F.coalesce(F.max("gamma"), F.lit(1.0)).alias("gamma")))


def model_keys(model: DataFrame, shards: int) -> DataFrame:
    """(shard, key, a, gamma): the model dealt to shards by the key its askers use."""
    bits = shards.bit_length() - 1

    @tk.tidy
    def step(batches):
        for batch in batches:
            lang, k, g = (batch.column(i).to_pylist() if i == 0 else batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            names = {x: language_hash(x) for x in set(lang)}
            key = np.empty(len(g), np.uint64)
            own = np.array([names[x] for x in lang], np.uint64)
            for n in np.unique(k):
                m = k == n
                key[m] = tk.mix64(g[m].view(np.uint64) * tk.U64(0x9FB21C651E98DF25) + tk.U64(n + 1) * own[m])
            yield pa.RecordBatch.from_arrays([pa.array((key >> tk.U64(64 - bits)).astype(np.int32)), pa.array(key.view(np.int64)),
                                              batch.column(3), batch.column(4)], ["shard", "key", "a", "gamma"])

    return model.select("lang", "k", "g", "a", "gamma").mapInArrow(step, "shard int, key long, a double, gamma double")


def bucket_grams(langs: list, buf: np.ndarray, offs: np.ndarray, order: int) -> dict:
    """Distinct full-order n-grams of a bucket's texts per language."""
    names = np.array(langs, object)
    found: dict = {lang: [np.zeros(0, np.uint64)] for lang in set(langs)}
    for code, rows in tk.gram_blocks(buf, offs, order, PAD):
        for lang in set(names[rows[0]:rows[-1] + 1]):
            found[lang].append(np.unique(code[(names == lang)[rows]]))
    return {lang: np.unique(np.concatenate(x)) for lang, x in found.items()}


def lookups(grams: dict, order: int) -> tuple[np.ndarray, list]:
    """Keys of all n-grams that the full-order ones need, and where they belong: (lang, k, codes)."""
    keys, places = [np.zeros(0, np.uint64)], []
    for lang, full in sorted(grams.items(), key=lambda x: (x[0] is None, x[0] or "")):
        for k in range(order + 1):
            # as n-gram: the last k bytes; as context of an order-(k+1) n-gram: the k bytes before its last
            own = full & np.uint64((1 << 8 * k) - 1)
            if 0 < k < order:
                own = np.concatenate([own, (full >> np.uint64(8)) & np.uint64((1 << 8 * k) - 1)])
            codes = np.unique(own) if k else np.zeros(min(1, len(full)), np.uint64)
            keys.append(keys_of(codes, k, language_hash(lang)))
            places.append((lang, k, codes))
    return np.concatenate(keys), places


def log_probabilities(full: np.ndarray, tables: list, order: int) -> np.ndarray:
    """log10 probability of each full-order n-gram, given (codes, a, gamma) for k = 0..order."""
    p = np.full(len(full), 1 / 256)
    for k in range(1, order + 1):
        codes, a, _ = tables[k]
        ctx_codes, _, gamma = tables[k - 1]
        g = full & np.uint64((1 << 8 * k) - 1)
        h = (g >> np.uint64(8)) if k > 1 else np.zeros(len(full), np.uint64)
        p = a[np.searchsorted(codes, g)] + gamma[np.searchsorted(ctx_codes, h)] * p
    return np.log10(p)


def recurring(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Share of each text's bytes whose 4-gram stood already within the ``NEAR`` bytes before."""
    n = len(offs) - 1
    found, last, of = np.zeros(n), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for code, rows in tk.gram_blocks(buf, offs, 4, PAD):
        past = len(last)  # the end of the block before
        code, rows = np.concatenate([last, code]), np.concatenate([of, rows])
        key = np.sort(code << np.uint64(32) | np.arange(len(code), dtype=np.uint64))
        at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        i = np.flatnonzero((key[1:] >> np.uint64(32) == key[:-1] >> np.uint64(32)) & (np.diff(at) <= NEAR) & (at[1:] >= past))
        i = i[rows[at[i + 1]] == rows[at[i]]]
        found += np.bincount(rows[at[i + 1]], minlength=n)
        last, of = code[-NEAR:], rows[-NEAR:]
    return found / np.maximum(np.diff(offs), 1)


def with_place(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns), ``file`` and ``row``; documents that do not come from files are staged first."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select(F.struct("*").alias("doc"), *place)
    except AnalysisException:
        return materialize(docs.select(F.struct("*").alias("doc")), "docs").select("doc", *place)


def scores(placed: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, lang, file, row, n (bytes), perplexity (per byte) and repeated (see ``recurring``) of ``with_place`` rows.

    Perplexity and repeated are null for empty texts.
    """
    shards = max(SHARDS, 1 << (-(-model.count() // SHARD_KEYS) - 1).bit_length())
    regions = -(-placed.count() // (REGION_ROWS * shards // SHARDS)) or 1
    size, rows = F.coalesce(F.octet_length("doc.text"), F.lit(0)), F.lit(1)
    for most, n in reversed(BUCKETS):
        rows = F.when(size <= most, n).otherwise(rows)
    slim = placed.select(F.struct(F.col("doc.doc_id").alias("doc_id"), "file", "row").alias("key"), F.col("doc.lang").cast("string").alias("lang"),
                         F.col("doc.text").alias("text"), F.xxhash64("file", rows, F.floor(F.col("row") / rows)).alias("_bucket"),
                         F.pmod(F.xxhash64("file", F.floor(F.col("row") / (1 << 14))), F.lit(regions)).cast("int").alias("_region"))

    @tk.tidy
    def ask(batches):
        for bucket, got in sh.bucket_chunks(batches):
            buf, offs = sh.text_of(got)
            langs = [x for p in got for x in p.column(p.schema.get_field_index("lang")).to_pylist()]
            region = got[0].column(got[0].schema.get_field_index("_region"))[0].as_py()
            keys = np.unique(lookups(bucket_grams(langs, buf, offs, order), order)[0])
            cut = sh.shard_cuts(keys, shards)
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * shards, pa.int64()), pa.array(range(shards), pa.int32()), pa.array([region] * shards, pa.int32()),
                                              pa.array([sh.pack_keys(keys[cut[i]:cut[i + 1]]) for i in range(shards)], pa.binary())],
                                             ["bucket", "shard", "region", "blob"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        rows = []
        key = known["key"].to_numpy().view(np.uint64)
        o = np.argsort(key)
        key, value = key[o], np.stack([known["a"].to_numpy()[o], known["gamma"].to_numpy()[o]], axis=1).astype("<f4")
        for blob in asked["blob"].to_pylist():
            k = sh.unpack_keys(blob)
            got = np.zeros((len(k), 2), "<f4")
            got[:, 1] = 1
            if len(key):
                at = np.minimum(np.searchsorted(key, k), len(key) - 1)
                hit = key[at] == k
                got[hit] = value[at[hit]]
            else:
                hit = np.zeros(len(k), bool)
            rows.append(len(k).to_bytes(8, "little") + sh.pack_keys(k[hit]) + got[hit].tobytes())
        return pa.table({"bucket": asked["bucket"], "shard": asked["shard"], "blob": pa.array(rows, pa.binary())})

    asked = slim.select("_bucket", "_region", "lang", "text").mapInArrow(ask, "bucket long, shard int, region int, blob binary")
    known = model_keys(model, shards).withColumn("region", F.explode(F.sequence(F.lit(0), F.lit(regions - 1))))
    answers = (asked.groupBy("shard", "region").cogroup(known.groupBy("shard", "region"))
                    .applyInArrow(answer, "bucket long, shard int, blob binary").where("bucket IS NOT NULL"))
    meet = sh.pack_texts(slim.drop("_region"), ["key", "lang"]).unionByName(answers)

    def score(table: pa.Table) -> pa.Table:
        shard, blobs = table["shard"].to_pylist(), table["blob"].to_pylist()
        del table
        known, value = [np.zeros(0, np.uint64)], [np.zeros((0, 2), "<f4")]
        for blob in (b for s, b in zip(shard, blobs) if s >= 0):
            size = len(blob) - 8
            n = int(np.frombuffer(blob, "<u4", 1, 8)[0])
            known.append(sh.unpack_keys(blob[8:]))
            value.append(np.frombuffer(blob, "<f4", 2 * n, 8 + size - 8 * n).reshape(n, 2))
        known, value = np.concatenate(known), np.concatenate(value)
        o = np.argsort(known)
        known, value = known[o], value[o].astype(np.float64)
        parts = []
        for packed in [b for s, b in zip(shard, blobs) if s < 0]:
            texts = sh.unpack_texts(packed).combine_chunks()
            buf, offs = tk.utf8(texts["text"].cast(pa.large_string()))
            langs = texts["lang"].to_pylist()
            grams = bucket_grams(langs, buf, offs, order)
            tables: dict = {}
            for lang, k, codes in lookups(grams, order)[1]:
                key = keys_of(codes, k, language_hash(lang))
                got = np.tile([0.0, 1.0], (len(codes), 1))
                if len(known):
                    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    hit = known[at] == key
                    got[hit] = value[at[hit]]
                tables.setdefault(lang, []).append((codes, got[:, 0], got[:, 1]))
            log_p = {lang: log_probabilities(full, tables[lang], order) for lang, full in grams.items()}
            names_of, total = np.array(langs, object), np.zeros(len(langs))
            for code, rows in tk.gram_blocks(buf, offs, order, PAD):
                for lang in set(names_of[rows[0]:rows[-1] + 1]):
                    m = (names_of == lang)[rows]
                    total += np.bincount(rows[m], weights=log_p[lang][np.searchsorted(grams[lang], code[m])], minlength=len(langs))
            n = np.diff(offs)
            out = np.where(n > 0, 10 ** np.minimum(-total / np.maximum(n, 1), 300), np.nan)
            parts.append(pa.table({"key": texts["key"], "lang": texts["lang"], "n": pa.array(n), "perplexity": pa.array(out, mask=np.isnan(out)),
                                   "repeated": pa.array(recurring(buf, offs), mask=np.isnan(out))}))
        tk.release()
        return pa.concat_tables(parts)

    schema = T.StructType([slim.schema["key"], slim.schema["lang"], T.StructField("n", T.LongType()), T.StructField("perplexity", T.DoubleType()),
                           T.StructField("repeated", T.DoubleType())])
    return meet.groupBy("bucket").applyInArrow(score, schema).select("key.*", "lang", "n", "perplexity", "repeated")


def perplexities(docs: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, lang, n (bytes), perplexity and repeated of every document."""
    return scores(with_place(docs), model, order).drop("file", "row")


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """The staged model table of all trusted documents of the training fold."""
    return materialize(kneser_ney(count_grams(_trusted(docs, labels, "train"), order), order), "kn_model")


def limits(held: DataFrame, quantiles: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """Limits of every value named in ``quantiles``, for each language (value, _l, own) and for all of them (value, all).

    ``held`` has lang, n (bytes) and the values; ``mu + k * sqrt(a + b / n)`` is the limit of a text of n bytes, own.m the number of
    documents behind it.  Percentiles are taken of values rounded to three places, so their buffers are small at any number of rows.
    """
    middle = lambda v: F.exp(F.percentile(F.round(F.log(v), 3), 0.5))
    named = F.array(*[F.struct(F.lit(v).alias("v"), F.col(v).alias("x")) for v in quantiles])
    rows = held.select("lang", "n", F.explode(named).alias("_x")).select("lang", "n", "_x.v", "_x.x").where("x IS NOT NULL")
    # every row counts for its language and for all languages
    x = rows.withColumn("pool", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("lang", F.when(~F.col("pool"), F.col("lang")))
    same = F.col("lang").eqNullSafe(F.col("l")) & (F.col("pool") == F.col("p")) & (F.col("v") == F.col("of"))
    key = (F.col("lang").alias("l"), F.col("pool").alias("p"), F.col("v").alias("of"))
    centre = x.groupBy(*key).agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mu"), (middle("n") * 0.99).alias("long"))
    away = x.join(F.broadcast(centre), same).withColumn("r2", (F.col("x") - F.col("mu")) ** 2 + 1e-9)
    spread = materialize(away.groupBy(*key).agg(F.first("mu").alias("mu"), middle(F.when(F.col("n") >= F.col("long"), F.col("r2"))).alias("a"),
                                                middle(F.col("r2") * F.col("n")).alias("b")), "kn_spread")
    z = (F.col("x") - F.col("mu")) / F.sqrt(F.col("a") + F.col("b") / F.col("n"))
    share = F.element_at(F.create_map(*[F.lit(y) for v in quantiles.items() for y in v]), F.col("of"))
    out = 1 / ((F.col("m") + 1) * (1 - share))  # above 1: too few texts to hold the quantile
    at = F.element_at(F.create_map(*[y for i, v in enumerate(quantiles) for y in (F.lit(v), F.get("q", F.lit(i)))]), F.col("of"))
    k = F.when(out <= 1, at).otherwise(F.col("most") + F.col("scale") * F.log(out))
    fits = (x.join(F.broadcast(spread), same).withColumn("z", z).groupBy("l", "p", "of", "mu", "a", "b")
             .agg(F.percentile(F.round("z", 3), list(quantiles.values())).alias("q"), F.max("z").alias("most"), F.avg(F.abs("z")).alias("scale"),
                  F.count(F.lit(1)).alias("m")).withColumn("k", k))
    fits = materialize(fits.select("l", "p", F.col("of").alias("value"), "mu", "a", "b", "k", "m"), "kn_fits")
    pooled = fits.where("p").select("value", F.struct("mu", "a", "b", "k").alias("all"))  # one row a value
    return fits.where(~F.col("p")).select("value", F.col("l").alias("_l"), F.struct("mu", "a", "b", "k", "m").alias("own")), pooled


def judged(placed: DataFrame, labels: DataFrame, quantile: float = 0.99, repeats: float = 0.999) -> DataFrame:
    """``scores`` with ``threshold`` (of the perplexity) and ``accepted``; all documents are scored once."""
    docs = placed.select("doc.doc_id", "doc.lang", "doc.text")
    out = materialize(scores(placed, train(docs, labels)), "kn_scored")
    held = materialize(_trusted(out, labels, "calibrate").select("lang", F.log("perplexity").alias("p"), "repeated", "n"), "kn_calibrate")
    n = F.greatest(F.col("n"), F.lit(1))
    owns, pools = limits(held, {"p": quantile, "repeated": repeats})
    for name, value in (("threshold", "p"), ("most", "repeated")):  # one row a language; one row or none
        own, pooled = (t.where(F.col("value") == value).drop("value") for t in (owns, pools))
        mine, every = (F.col(f"{c}.mu") + F.col(f"{c}.k") * F.sqrt(F.col(f"{c}.a") + F.col(f"{c}.b") / n) for c in ("own", "all"))
        limit = mine + PRIOR / (F.col("own.m") + PRIOR) * F.greatest(every - mine, F.lit(0.0))
        # a left join to the pooled row, which is missing where nothing calibrates
        out = (out.join(F.broadcast(own), F.col("lang").eqNullSafe(F.col("_l")), "left").join(F.broadcast(pooled), F.lit(True), "left")
                  .withColumn(name, F.coalesce(limit, every)).drop("_l", "own", "all"))
    return (out.withColumn("threshold", F.exp("threshold"))
               .withColumn("accepted", F.coalesce((F.col("perplexity") <= F.col("threshold")) & (F.col("repeated") <= F.col("most")), F.lit(True)))
               .drop("repeated", "most"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, repeats: float = 0.999) -> DataFrame:
    """doc_id, lang, perplexity, threshold (of the perplexity) and accepted of every document."""
    return judged(with_place(docs), labels, quantile, repeats).drop("file", "row", "n")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, repeats: float = 0.999) -> DataFrame:
    """``docs`` with ``perplexity``, ``threshold`` (of the perplexity) and ``accepted``."""
    placed = with_place(docs.drop("perplexity", "threshold", "accepted"))
    found = judged(placed, labels, quantile, repeats).select("file", "row", "perplexity", "threshold", "accepted")
    return placed.join(found, ["file", "row"]).select("doc.*", "perplexity", "threshold", "accepted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The accepted rows of ``docs``, with its columns."""
    placed = with_place(docs)
    found = judged(placed, labels).where("accepted").select("file", "row")
    return placed.join(found, ["file", "row"], "left_semi").select("doc.*")
