"""Approximate nearest neighbours by an inverted-file index.

``build`` fits centroids on a bounded hash sample, gives every row the list of its nearest centroid and writes the
table partitioned by list.  ``search`` sends every query to its ``probes`` nearest lists: the read is pruned to the lists
that some query of a block probes, and a row is compared only with the queries that probe its list.  With all lists
probed the result is the exact one of ``vector.similar_rows_batch``.

Nothing is grouped by list: rows are written by the task that reads them, so a list that holds a third of all rows
is many files and many tasks.  The centroids (``lists`` x dimensions, checked) and one block of queries are broadcast; a
task keeps its k best per query of the block, and the merge ranks k x partitions rows per query at most.

Defined results: vectors that are null, or hold null or non-finite numbers, are in no list and near to nothing, as
queries or as rows; ties go by id; an empty table has an empty index, and its queries have no neighbours.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlens.operators.vector import MAX_BROADCAST_FLOATS
from ledgerlens.session import scratch_path

MAX_CENTROID_FLOATS = 8_000_000
_COMPARED = 4_000_000  # distances taken at once


def usable(vec: str) -> Column:
    """Whether a vector can be near to anything."""
    ok = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & ok, F.lit(False))


@dataclass
class Index:
    """Where an index lies, and its centroids."""

    path: str
    centroids: np.ndarray
    key: str
    vec: str

    @property
    def lists(self) -> int:
        return len(self.centroids)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")


def fit_centroids(df: DataFrame, key: str, vec: str, lists: int, sample: int = 50_000, rounds: int = 10) -> np.ndarray:
    """At most ``lists`` centroids by k-means over the ``sample`` rows with the smallest id hashes."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    total = df.count()
    share = min(1.0, 2 * sample / max(total, 1))  # so only about twice the sample is sorted
    h = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    some = df.where(h < int(share * (1 << 31))).orderBy(h, key).limit(sample).select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    if not total:
        return np.zeros((0, 0))
    model = KMeans(k=min(lists, total), maxIter=rounds, seed=11).fit(some)
    return np.array(model.clusterCenters())


def nearest_lists(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centroids of every row, nearest first (ties by number)."""
    out = np.empty((len(x), min(n, len(centroids))), np.int32)
    norm = (centroids * centroids).sum(axis=1)
    step = max(1, _COMPARED // max(1, len(centroids)))
    for lo in range(0, len(x), step):
        d = norm[None, :] - 2 * (x[lo:lo + step] @ centroids.T)
        out[lo:lo + step] = np.argsort(d, axis=1, kind="stable")[:, :out.shape[1]]
    return out


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def build(df: DataFrame, key: str = "id", vec: str = "embeddings", lists: int = 64, sample: int = 50_000, path: str | None = None) -> Index:
    """Write an index of every usable row of ``df``; returns it.

    Vectors must have one length.  About the square root of the number of rows is a good number of lists.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "ivf")
    data = df.select(F.col(key).cast("long").alias(key), F.col(vec).cast("array<float>").alias(vec)).where(usable(vec))
    centroids = fit_centroids(data, key, vec, lists, sample)
    if centroids.size > MAX_CENTROID_FLOATS:
        raise ValueError(f"{centroids.shape} centroids are more than may be broadcast")
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1), shared.value.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nearest_lists(x, shared.value, 1)[:, 0])], [key, vec, "list"])

    placed = data.mapInArrow(assign, T.StructType([T.StructField(key, T.LongType()), T.StructField(vec, T.ArrayType(T.FloatType())), T.StructField("list", T.IntegerType())]))
    placed.write.mode("overwrite").partitionBy("list").parquet(f"{path}/rows")
    if not len(centroids):  # no partition to read a schema from
        placed.write.mode("overwrite").parquet(f"{path}/rows")
    spark.createDataFrame([(json.dumps(centroids.tolist()),)], "centroids string").write.mode("overwrite").text(f"{path}/centroids")
    return Index(path, centroids, key, vec)


def open_index(spark: SparkSession, path: str, key: str = "id", vec: str = "embeddings") -> Index:
    """An index written before."""
    text = spark.read.text(f"{path}/centroids", wholetext=True).first()["value"]
    return Index(path, np.array(json.loads(text), np.float64), key, vec)


def _local(shared, k: int, key: str):
    """Per task: the k best rows of each query among the rows of the lists it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, ids, probing = shared.value  # probing: list -> places of its queries
        dim = vectors.shape[1]
        best = {}  # place -> (distances, ids)
        for b in batches:
            if not b.num_rows:
                continue
            names, x, of = b.column(0).to_numpy(), _matrix(b.column(1), dim), b.column(2).to_numpy()
            for part in np.unique(of).tolist():
                asked = probing.get(part)
                if asked is None:
                    continue
                rows = np.flatnonzero(of == part)
                step = max(1, _COMPARED // (len(rows) * dim) or 1)
                for lo in range(0, len(asked), step):
                    some = asked[lo:lo + step]
                    diff = x[rows][None, :, :] - vectors[some][:, None, :]
                    d = np.sqrt((diff * diff).sum(axis=2))
                    order = np.lexsort((np.broadcast_to(names[rows], d.shape), d), axis=1)[:, :k]
                    for q, o, row in zip(some.tolist(), order, d):
                        near, who = row[o], names[rows[o]]
                        if q in best:
                            near, who = np.concatenate([best[q][0], near]), np.concatenate([best[q][1], who])
                            keep = np.lexsort((who, near))[:k]
                            near, who = near[keep], who[keep]
                        best[q] = (near, who)
        if best:
            n = [len(v[0]) for v in best.values()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[list(best)], n)), pa.array(np.concatenate([v[1] for v in best.values()])),
                                              pa.array(np.concatenate([v[0] for v in best.values()]))], ["query_id", key, "distance"])

    return run


def probed(index: Index, spark: SparkSession, lists: list[int]) -> DataFrame:
    """Rows of some lists; the others' files are not read."""
    return index.rows(spark).where(F.col("list").isin(lists) if lists else F.lit(False))


def search(index: Index, queries: DataFrame, k: int = 10, probes: int = 8) -> DataFrame:
    """k nearest rows of every query's ``probes`` nearest lists: (query_id, id, distance, rank), ties by id.

    ``queries`` has (query_id, the vector column) and may have any size: blocks of at most ``MAX_BROADCAST_FLOATS`` numbers
    are answered and written one after the other.
    """
    spark, key, vec = queries.sparkSession, index.key, index.vec
    schema = f"query_id bigint, `{key}` bigint, distance double, rank int"
    found_at = scratch_path(spark, "ivf_found")
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col(vec).cast("array<float>").alias(vec)).where(usable(vec))
    n = asked.count() if index.lists else 0
    if not n:
        return spark.createDataFrame([], schema)
    dim = index.centroids.shape[1]
    block = max(1, MAX_BROADCAST_FLOATS // dim)
    blocks = 1 if n <= block else -(-2 * n // block)
    asked_at = scratch_path(spark, "ivf_queries")
    asked.withColumn("_blk", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).write.partitionBy("_blk").parquet(asked_at)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", key))  # k x partitions rows at most
    for b in range(blocks):
        t = spark.read.parquet(asked_at).where(F.col("_blk") == b).select("query_id", vec).toArrow()
        for at in range(0, t.num_rows, block):
            part = t.slice(at, block).combine_chunks()
            x = _matrix(part[vec].combine_chunks(), dim)
            near = nearest_lists(x, index.centroids, probes)
            o = np.argsort(near.ravel(), kind="stable")
            lists, first = np.unique(near.ravel()[o], return_index=True)
            probing = dict(zip(lists.tolist(), np.split(o // near.shape[1], first[1:])))
            shared = spark.sparkContext.broadcast((x, part["query_id"].to_numpy(), probing))
            rows = probed(index, spark, lists.tolist()).select(key, vec, "list")
            best = rows.mapInArrow(_local(shared, k, key), f"query_id bigint, `{key}` bigint, distance double")
            best.withColumn("rank", rank).where(F.col("rank") <= k).write.mode("append").parquet(found_at)
            shared.destroy()
    return spark.read.schema(schema).parquet(found_at)
