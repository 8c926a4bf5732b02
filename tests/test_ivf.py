"""The inverted-file index against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ivf
from ledgerlens.operators import vector as V


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 3
    x = (centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(6000, None), (6001, [float("nan")] * 16), (6002, [None] * 16), (6003, x[0].tolist()), (6004, [])]
    df = spark.createDataFrame(rows, "id long, embeddings array<float>").repartition(6)
    from ledgerlens.session import materialize
    return materialize(df, "ivf_test")


@pytest.fixture(scope="module")
def index(table):
    return ivf.build(table, lists=48, sample=3000)


def pairs(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["distance"], 5)) for r in df.collect())


def asked(table, every=20):
    return table.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "embeddings")


def test_every_usable_row_is_in_one_list(spark, table, index):
    assert sorted(r["id"] for r in index.rows(spark).collect()) == [*range(6000), 6003]


def test_all_lists_give_the_exact_result(table, index, monkeypatch):
    q = asked(table)
    exact = pairs(V.similar_rows_batch(table.where(F.size("embeddings") > 0), q.where("query_id < 6000"), k=10))
    assert pairs(ivf.search(index, q, k=10, probes=index.lists)) == exact
    monkeypatch.setattr(ivf, "MAX_BROADCAST_FLOATS", 16 * 70)  # several blocks of queries
    monkeypatch.setattr(ivf, "_COMPARED", 5000)
    assert pairs(ivf.search(index, q, k=10, probes=index.lists)) == exact


def test_recall_and_bytes_read(spark, table, index):
    q = asked(table)
    exact = {(a, c) for a, _, c, _ in pairs(V.similar_rows_batch(table.where(F.size("embeddings") > 0), q.where("query_id < 6000"), k=10))}
    recall = []
    for probes in (1, 4, 12):
        found = {(a, c) for a, _, c, _ in pairs(ivf.search(index, q, k=10, probes=probes))}
        recall.append(len(found & exact) / len(exact))
    assert recall[0] <= recall[1] <= recall[2] and recall[1] >= 0.9 and recall[2] > 0.98
    # one query: the files read fall with its probes
    x = np.array(table.where("id = 40").first()["embeddings"])[None, :]
    read = []
    for probes in (1, 4, 48):
        rows = ivf.probed(index, spark, ivf.nearest_lists(x, index.centroids, probes)[0].tolist())
        files = rows.select("_metadata.file_path", "_metadata.file_size").distinct().collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "list" in plan.split("PartitionFilters: [")[1].split("]")[0]
        read.append(sum(f["file_size"] for f in files))
    assert read[0] * 10 < read[2] and read[0] < read[1] < read[2]


def test_reopened_index_and_edges(spark, table, index):
    again = ivf.open_index(spark, index.path)
    q = asked(table, 500)
    assert pairs(ivf.search(again, q, k=3, probes=5)) == pairs(ivf.search(index, q, k=3, probes=5))
    odd = spark.createDataFrame([(1, None), (2, [float("inf")] * 16)], "query_id long, embeddings array<float>")
    assert ivf.search(index, odd).count() == 0
    none = ivf.build(table.where("false"))
    assert none.lists == 0 and ivf.search(none, q).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "id long, embeddings array<float>")
    got = pairs(ivf.search(ivf.build(same, lists=4), same.where("id = 7").withColumnRenamed("id", "query_id"), k=5, probes=4))
    assert [(r, i) for _, r, i, _ in got] == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]  # ties by id
