"""Session construction and the shared scratch location.

Intermediate tables (written CSV/text fixtures, stream sinks, checkpoints) go
under the folder named by ``spark.checkpoint.dir``: on a cluster that is a
shared file system every executor can reach.  Only when it is unset (unit
tests, a laptop) do we set one ourselves, below the warehouse directory; on any other master that
is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SCRATCH_SUBDIR = "ledgerlens"

#: the share of its limit that the driver's heap has without a collection after each staged table
HEAP_SHARE = 1 / 2

_MB = 1 << 20


def cluster_conf(input_bytes: int, cores: int, target_partition_mb: int = 256, shuffle_partition_mb: int = 1536) -> dict[str, str]:
    """Scan and shuffle sizes for an input of ``input_bytes`` on ``cores`` cores.

    * scan splits of ``target_partition_mb`` (``maxPartitionBytes``), so a 100 TB input is ~400k tasks;
    * an initial shuffle width of input / ``shuffle_partition_mb`` (never below 2x the cores): a shuffle keeps one
      entry per map task and reducer, so reducers are larger than scans and spill where they must (100 TB: ~68k).
      AQE coalesces after a selective filter;
    * skew handling: a shuffle partition over 4x the median and over 3 GB is split;
    * broadcast joins only for sides measured under 64 MB at run time.
    """
    width = max(2 * cores, input_bytes // (shuffle_partition_mb * _MB) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * shuffle_partition_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def get_session(master: str | None = None, app: str = "ledgerlens", shuffle_partitions: int | None = None,
                extra: dict | None = None, input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session.  With ``input_bytes`` and ``cores`` the partition sizing of
    ``cluster_conf`` is applied (cluster runs); tests pass a small ``shuffle_partitions`` instead."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if input_bytes is not None and cores:
        conf.update(cluster_conf(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set one only when none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        root = warehouse.rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/{_SCRATCH_SUBDIR}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root and this application's own folder, unique per call."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this application, in any store; anything else is refused."""
    if not path.startswith(_scratch_root(spark) + "/"):
        raise ValueError(f"not a scratch folder of this application: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage once its heap has grown beyond ``HEAP_SHARE`` of its limit.

    Spark drops the broadcasts and shuffles of finished jobs only after a collection, and the heap gives memory back
    only then; left alone, a query of many small jobs lets it grow to the limit, whatever it still needs.
    """
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > HEAP_SHARE * heap.maxMemory():
        spark._jvm.java.lang.System.gc()


def materialize(df, name: str):
    """Write ``df`` as parquet below the shared checkpoint root and return the re-read table.

    Cuts the lineage (a lost executor recomputes from these files, not from the raw input) and lets
    later passes read only the columns they need instead of re-parsing text.  What the job left on the
    driver is collected (``collect_garbage``).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    collect_garbage(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def spread(df):
    """``df`` dealt evenly over the cluster, whatever files and row groups it was read from: for work in Python, which a
    scan of one row group would leave to one task."""
    from pyspark.sql import functions as F
    return df.repartition(F.monotonically_increasing_id())
