"""Language identification by nearest centroid over normalised TF-IDF byte n-gram vectors.

Letters are lowered (ASCII), every other ASCII byte becomes a space; the n-grams (1 to 3 bytes, so
that accented letters are whole) are hashed to ``DIMS`` columns.  A document's vector is
``(1 + log tf) * idf``, scaled to length one.  Each language has ``clusters`` centroids (spherical
k-means).  The prediction is the language of the nearest centroid by cosine; ``score`` is that
cosine, and ``rejected`` marks documents farther from it than nearly all training documents of
that language were (the ``reject`` quantile of their cosines).

Learning: document frequencies (for idf) are counted over every training document; each task adds
its own ``DIMS`` counters first.  The centroids are clustered from at most ``sample`` documents of
every language (smallest id hash), the documented bound of the fit, drawn for all languages in one
scan and clustered in one task per language; the centroids reach the driver.  What tasks get is
``DIMS`` idf weights and languages x clusters centroids.

Defined results: a null text or one without a letter: ``und``, score 0.  No training document: all
``und``.  Training uses documents with a language and a letter only.  Ties go to the language that
sorts first.  Repeated rows are predicted alike.  Extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlens.llm import textkit as tk

DIMS = 4096
_CLASS = np.full(256, 32, np.uint8)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def profile(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """n-gram counts of every text, one row of ``DIMS`` each."""
    n = len(offs) - 1
    out = np.zeros(n * DIMS, np.float32)
    for code, rows in tk.gram_blocks(_CLASS[buf], offs, 3, pad=32):
        code = code.astype(np.uint32)
        for k in (1, 2, 3):
            g = code & np.uint32((1 << 8 * k) - 1)
            h = ((g + np.uint32(k) * np.uint32(0x51ED270B)) * np.uint32(0x9E3779B1)) >> np.uint32(20)
            keep = g != (0, 32, 0x2020, 0x202020)[k]
            out += np.bincount(rows[keep] * DIMS + h[keep], minlength=n * DIMS).astype(np.float32)
    return out.reshape(n, DIMS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def has_letter(texts) -> np.ndarray:
    """Whether each text has a letter of any script (nearly always found in the first characters)."""
    return np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)


def _chunks(batch, limit: int = 1 << 20, rows: int = 256):
    buf, offs = tk.utf8(batch.column(batch.schema.get_field_index("text")))
    for lo, hi in tk.row_chunks(offs, limit):
        for a in range(lo, hi, rows):
            b = min(a + rows, hi)
            yield a, b, buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each column occurs, and their number."""
    @tk.tidy
    def step(batches):
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            use = has_letter(batch.column(batch.schema.get_field_index("text")).to_pylist())
            for a, b, buf, offs in _chunks(batch):
                df += (profile(buf, offs)[use[a:b]] > 0).sum(axis=0)
            n += int(use.sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], ["dim", "n"])

    total = train.select("text").mapInArrow(step, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()  # DIMS + 1 rows at most
    df = np.zeros(DIMS)
    for r in total:
        if r["dim"] >= 0:
            df[r["dim"]] = r["n"]
    return df, next((r["n"] for r in total if r["dim"] < 0), 0)


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; the first centre is the mean, the next the farthest vectors."""
    centres = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        near = np.max(x @ np.stack(centres).T, axis=1)
        centres.append(x[int(np.argmin(near))])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def fit(train: DataFrame, clusters: int = 4, sample: int = 600, reject: float = 0.001) -> dict:
    """idf, centroids, their languages, and the smallest cosine each language accepts."""
    df, n = document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)) + 1
    h = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 31))
    # a row per language; the model broadcast later holds ``clusters`` centroids for each of them
    share = train.groupBy(F.col("lang").alias("_l")).agg((F.lit(2.0 * sample) / F.count(F.lit(1))).alias("_share"))
    some = (train.join(F.broadcast(share), F.col("lang") == F.col("_l")).select("lang", h.alias("h"), "text", "_share")
                 .where(F.col("h") < F.col("_share") * (1 << 31))
                 .withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("_n") <= sample))

    @tk.tidy
    def featurise(batches):
        for batch in batches:
            use = has_letter(batch.column(batch.schema.get_field_index("text")).to_pylist())
            for a, b, buf, offs in _chunks(batch):
                v = vectors(profile(buf, offs), idf)[use[a:b]].astype(np.float32)
                keep = pa.array(a + np.flatnonzero(use[a:b]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep),
                                                  pa.array([x.tobytes() for x in v], pa.binary())], ["lang", "h", "v"])

    def centroids(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["h"].to_pylist(), table["v"].to_pylist()))  # ``sample`` vectors at most
        x = np.stack([np.frombuffer(v, np.float32) for _, v in rows]).astype(np.float64)
        c = cluster(x, clusters)
        return pa.table({"lang": table["lang"].slice(0, 1), "k": pa.array([len(c)], pa.int32()), "centres": pa.array([c.tobytes()], pa.binary()),
                         "floor": pa.array([float(np.quantile((x @ c.T).max(axis=1), reject))])})

    fitted = (some.select("lang", "h", "text").mapInArrow(featurise, "lang string, h long, v binary")
                  .groupBy("lang").applyInArrow(centroids, "lang string, k int, centres binary, floor double").collect())
    names, centres, floors = [], [], []
    for r in sorted(fitted, key=lambda r: r["lang"]):
        names += [r["lang"]] * r["k"]
        centres.append(np.frombuffer(r["centres"]).reshape(r["k"], -1))
        floors += [r["floor"]] * r["k"]
    return {"idf": idf, "names": names, "floors": np.array(floors),
            "centres": np.concatenate(centres) if centres else np.zeros((0, DIMS))}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` from the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x (languages x clusters + 1) doubles
    plain = docs.drop("lang_pred", "score", "rejected")
    schema = T.StructType([*plain.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    @tk.tidy
    def step(batches):
        m = held.value
        for batch in batches:
            use = has_letter(batch.column(batch.schema.get_field_index("text")).to_pylist())
            lang, score, rejected = ["und"] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            for a, b, buf, offs in _chunks(batch):
                if len(m["names"]):
                    cos = vectors(profile(buf, offs), m["idf"]) @ m["centres"].T
                    best = np.argmax(cos, axis=1)
                    for i in np.flatnonzero(use[a:b]):
                        j = int(best[i])
                        lang[a + i], score[a + i] = m["names"][j], min(1.0, max(0.0, cos[i, j]))
                        rejected[a + i] = cos[i, j] < m["floors"][j]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang), pa.array(score), pa.array(rejected)],
                                             [*batch.schema.names, "lang_pred", "score", "rejected"])

    return plain.mapInArrow(step, schema)


def identify(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """Predict every document; learn from those with a language whose crc32(doc_id) % parts != held."""
    fold = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "UTF-8")) % parts
    train = docs.where((fold != held) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    return (predict(docs.select("doc_id", "text"), fit(train)).withColumn("held_out", fold == held)
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))
