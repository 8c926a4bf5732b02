"""Exact nearest neighbours by L2 distance.

``similar_rows``: the target row's vector is a one-row scalar subquery, broadcast, and
the k nearest come out of ``orderBy(dist, id).limit(k)`` - Spark plans it as a
TakeOrderedAndProject: each task keeps its k best, the driver merges k per task.

``similar_rows_batch``: many query vectors at once, block by block.  One block of a checked size is
broadcast, answered, written and dropped before the next; each data partition keeps only its k
nearest rows per query (numpy inside ``mapInArrow``), and a shuffle by query id merges at most
``k x partitions`` candidates per query.  No query x row pair is ever materialised as a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions.vector import l2_distance
from ledgerlens.session import scratch_path

# Largest query block broadcast at once: block rows x dimensions x 8 bytes stays ~64 MB.
MAX_BROADCAST_FLOATS = 8_000_000


def scalar_subquery(df: DataFrame, target_id, key: str = "id", vec: str = "embeddings") -> DataFrame:
    """Every row with its distance to the row ``key == target_id`` (the target vector is one broadcast row).

    A missing target gives NULL distances; a target id on two rows is an error, as in SQL.
    """
    same = df.filter(F.col(key) == F.lit(target_id))
    target = same.agg(F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("more than one row for the target id")).cast(df.schema[vec].dataType))
                       .otherwise(F.min(vec)).alias("_t"))
    return df.crossJoin(F.broadcast(target)).withColumn("distance", l2_distance(vec, "_t")).drop("_t")


def similar_rows(df: DataFrame, target_id, k: int = 100, key: str = "id", vec: str = "embeddings",
                 cols: list[str] | None = None) -> DataFrame:
    """The k rows nearest to the target row (the target itself first, at distance 0)."""
    d = scalar_subquery(df, target_id, key, vec)
    return d.select(key, *(cols or []), "distance").orderBy(F.col("distance").asc_nulls_last(), key).limit(k)


_QUERY_CHUNK = 512
# Exact distances are taken for so many numbers at once (32 MB), however many rows tie.
_EXACT_FLOATS = 4_000_000


def _local_topk_fn(bq, k: int, key: str, vec: str):
    """Per partition: for each query keep the k rows smallest by (exact distance, id).

    Candidates are pre-selected on the cheap expansion |q|^2 - 2 q.x + |x|^2, keeping every row
    within a floating-point error bound of the query's k-th value - so rows tied with the k-th
    are never cut - and only those get exact distances.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qv, qids = bq.value
        n_q, dim = qv.shape
        best_d = np.full((n_q, 0), np.inf)
        best_i = np.zeros((n_q, 0), dtype=np.int64)
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = b.column(key).to_numpy(zero_copy_only=False).astype(np.int64)
            x = b.column(vec).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            n = x.shape[0]
            xn = (x * x).sum(axis=1)
            new_d, new_i = [], []
            for s0 in range(0, n_q, _QUERY_CHUNK):
                q = qv[s0:s0 + _QUERY_CHUNK]
                qn = (q * q).sum(axis=1)
                d2 = qn[:, None] - 2.0 * (q @ x.T) + xn[None, :]
                m = min(k, n)
                kth = np.partition(d2, m - 1, axis=1)[:, m - 1]
                tol = 1e-9 * (qn + xn.max()) + 1e-12          # far above the expansion's rounding error
                width = int((d2 <= (kth + tol)[:, None]).sum(axis=1).max())
                cand = np.argpartition(d2, width - 1, axis=1)[:, :width] if width < n else \
                    np.tile(np.arange(n), (q.shape[0], 1))
                exact = np.empty(cand.shape)
                step = max(1, _EXACT_FLOATS // (cand.shape[1] * dim))
                for q0 in range(0, len(q), step):
                    diff = x[cand[q0:q0 + step]] - q[q0:q0 + step, None, :]
                    exact[q0:q0 + step] = np.sqrt((diff * diff).sum(axis=2))
                # of the ties, only the k first by (distance, id) can stay
                order = np.lexsort((ids[cand], exact), axis=1)[:, :k]
                new_d.append(np.take_along_axis(exact, order, axis=1))
                new_i.append(np.take_along_axis(ids[cand], order, axis=1))
            width = max(d.shape[1] for d in new_d)
            pad_d = [np.pad(d, ((0, 0), (0, width - d.shape[1])), constant_values=np.inf) for d in new_d]
            pad_i = [np.pad(i, ((0, 0), (0, width - i.shape[1])), constant_values=np.iinfo(np.int64).max) for i in new_i]
            cd = np.concatenate([best_d, np.concatenate(pad_d)], axis=1)
            ci = np.concatenate([best_i, np.concatenate(pad_i)], axis=1)
            order = np.lexsort((ci, cd), axis=1)[:, :k]
            best_d = np.take_along_axis(cd, order, axis=1)
            best_i = np.take_along_axis(ci, order, axis=1)
        if best_d.shape[1] == 0:
            return
        keep = np.isfinite(best_d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(qids, best_d.shape[1])[keep.ravel()], pa.int64()),
             pa.array(best_i.ravel()[keep.ravel()], pa.int64()),
             pa.array(best_d.ravel()[keep.ravel()], pa.float64())], names=["query_id", key, "distance"])
    return run


def similar_rows_batch(df: DataFrame, queries: DataFrame, k: int = 10, key: str = "id",
                       vec: str = "embeddings") -> DataFrame:
    """k nearest rows for every query row: ``(query_id, id, distance, rank)``, ties broken by id.

    ``queries`` has ``(query_id, embeddings)``.  The query set may have any size: it is written in blocks
    of at most ``MAX_BROADCAST_FLOATS`` numbers, and only one block at a time is on the driver and in a
    broadcast (one pass over the data per block).  Each partition returns its k best per query; the
    merge ranks at most ``k x partitions`` rows per query.  Vectors that are null or hold null or
    non-finite numbers, as rows or as queries, are near to nothing.
    """
    spark = df.sparkSession
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col(vec).isNotNull() & finite
    data = df.select(key, vec).filter(usable)
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), vec).filter(usable)
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("dim")).first()
    if not size["n"]:
        return spark.createDataFrame([], f"query_id bigint, {key} bigint, distance double, rank int")
    dim = size["dim"]
    block = max(1, MAX_BROADCAST_FLOATS // max(dim, 1))
    n_blocks = -(-size["n"] // block) if size["n"] <= block else -(-2 * size["n"] // block)
    queries_at, found_at = scratch_path(spark, "queries"), scratch_path(spark, "nearest")
    (asked.withColumn("_blk", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))).repartition("_blk")
          .write.partitionBy("_blk").parquet(queries_at))
    qb = spark.read.parquet(queries_at)
    w = Window.partitionBy("query_id").orderBy("distance", key)  # <= k x partitions rows per query
    for bi in range(n_blocks):
        t = qb.filter(F.col("_blk") == bi).select("query_id", vec).toArrow()  # about half a block
        for at in range(0, t.num_rows, block):
            part = t.slice(at, block).combine_chunks()
            qv = part[vec].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, dim)
            bq = spark.sparkContext.broadcast((qv, part["query_id"].to_numpy().astype(np.int64)))
            cand = data.mapInArrow(_local_topk_fn(bq, k, key, vec), f"query_id bigint, {key} bigint, distance double")
            best = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            best.write.mode("append").parquet(found_at)
            bq.destroy()
    return spark.read.schema(f"query_id bigint, {key} bigint, distance double, rank int").parquet(found_at)
