"""Session helpers: shared scratch folders, partition sizing."""

import pytest

from ledgerlens import session
from ledgerlens.session import checkpoint_root, cluster_conf, materialize, remove_path, scratch_path


def test_scratch_is_under_the_checkpoint_root_and_fresh(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30, cores=64)
    big = cluster_conf(100 << 40, cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128            # floor of 2x cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (1536 << 20) + 1
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_only_own_scratch_is_removed(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_path(spark, str(tmp_path))


def test_staging_collects_the_drivers_garbage_once_its_heap_has_grown(spark, monkeypatch):
    jvm = spark._jvm
    kinds = jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    ran = lambda: sum(b.getCollectionCount() for b in kinds if not any(x in b.getName() for x in ("Young", "Concurrent")))
    for share, collects in ((0.0, True), (1.0, False)):
        monkeypatch.setattr(session, "HEAP_SHARE", share, raising=False)
        before = ran()
        assert sorted(r["id"] for r in materialize(spark.range(3), "kept").collect()) == [0, 1, 2]
        assert (ran() > before) == collects
