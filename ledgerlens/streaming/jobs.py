"""Structured Streaming jobs.

The original job read a Kafka topic, appended each micro-batch to parquet, waited three
seconds, trained a regression on whatever had landed, then scored the same stream into
a second topic.  Here:

* every query has its own checkpoint folder under the shared checkpoint root, so a
  restarted job resumes where it stopped;
* the landing sink writes each micro-batch to a folder named by its batch id with
  ``overwrite``: a batch replayed after a failure replaces itself instead of duplicating;
* training waits for the landing query to finish (``trigger(availableNow=True)``), and
  scoring uses a hash hold-out, not the training rows.

Kafka needs the ``spark-sql-kafka`` package on the cluster; without it the same jobs run
on a file source (a parquet folder), which is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.hashing import unit_hash
from ledgerlens.operators.cleaning import TRAIN_SCHEMA, array_to_columns, parse_json
from ledgerlens.operators.ml import assemble_features, linear_fit
from ledgerlens.session import scratch_path

FEATURES = ["X1", "X2", "X3"]

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])


def train_records(events: DataFrame, parsed_only: bool = False, relation: bool = False) -> DataFrame:
    """Events as train messages: key ``"0"``/``"1"``, value JSON ``{"X": [value, k, hour], "y": value}``.

    ``relation``: the producer's relation instead, ``y = x1 + x2 + x3`` over scaled inputs
    ``X = [2 x1, 3 x2, x3]``, so that a right fit has the coefficients 1/2, 1/3 and 1.
    """
    x1, x2, x3 = F.col("value"), F.get_json_object("props", "$.k").cast("double"), F.hour("ts").cast("double")
    x = F.array(x1 * 2, x2 * 3, x3) if relation else F.array(x1, x2, x3)
    if parsed_only:
        return events.select("event_id", x.alias("X"))
    body = F.to_json(F.struct(x.alias("X"), (x1 + x2 + x3 if relation else x1).alias("y")))
    return events.select("event_id", (F.col("event_id") % 2).cast("string").cast("binary").alias("key"),
                         body.cast("binary").alias("value"))


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 options: dict[str, str] | None = None) -> DataFrame:
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).options(**(options or {}))
            .option("subscribe", topic).option("startingOffsets", starting).load())


def file_source(spark: SparkSession, folder: str, glob: str = "events.parquet", schema=EVENTS_SCHEMA,
                max_files: int | None = None) -> DataFrame:
    """A parquet folder as a stream (the stand-in for a topic when no broker is around)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def stream_source(spark: SparkSession, sf_dir: str, kafka: dict | None = None, relation: bool = False) -> DataFrame:
    """Train messages as a stream: from Kafka when configured, else built from the events files."""
    if kafka:
        return kafka_source(spark, kafka["servers"], kafka["topic"], options=kafka.get("options"))
    return train_records(file_source(spark, sf_dir), relation=relation)


def stream_features(stream: DataFrame) -> DataFrame:
    """bytes -> JSON struct -> X1..X3 -> feature vector (stateless, so it works on a stream).

    A malformed message keeps its row, with NULL where a value is missing (NaN in the vector).
    """
    p = parse_json(stream, "value", TRAIN_SCHEMA, "raw_data")
    keep = ["event_id"] if "event_id" in stream.columns else []
    cols = p.select(*keep, F.col("raw_data.y").alias("y"), F.col("raw_data.X").alias("X"))
    cols = array_to_columns(cols, "X", 3).drop("X")
    return assemble_features(cols, FEATURES, "features", handle_invalid="keep")


def idempotent_append(path: str, fmt: str = "parquet"):
    """``foreachBatch`` writer: batch n goes to ``path/batch_id=n`` with overwrite, so a replay cannot duplicate."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def run_to_end(stream: DataFrame, name: str, checkpoint: str, sink=None, fmt: str | None = None, path: str | None = None,
               mode: str = "append") -> None:
    """Start a query that processes everything available now, and wait for it to finish."""
    w = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).outputMode(mode) \
              .trigger(availableNow=True)
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format(fmt).option("path", path)
    q = w.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def land_stream(spark: SparkSession, stream: DataFrame, tag: str = "land", root: str | None = None) -> str:
    """Append every micro-batch of ``stream`` to parquet; return the folder.

    ``root`` holds the data and the checkpoint: a later call with it goes on where this one ended.
    """
    root = root or scratch_path(spark, tag)
    out = f"{root}/data"
    run_to_end(stream, f"{tag}_{root[-12:]}", f"{root}/_checkpoint", sink=idempotent_append(out))
    return out


def stream_sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = stream_features(stream_source(spark, sf_dir)).drop("features")
    return spark.read.parquet(land_stream(spark, feats, "landing"))


def json_sink(spark: SparkSession, scored: DataFrame, tag: str = "predict", kafka: dict | None = None,
              root: str | None = None) -> str | None:
    """``to_json(struct(y, prediction)) AS value`` appended to a topic, or to text files without a broker.

    ``root`` holds the checkpoint (and the files), so that a restart does not publish again;
    ``kafka["options"]`` go to the writer as they are (security, SASL).
    """
    out = scored.select(F.to_json(F.struct(F.col("y"), F.col("prediction"))).alias("value"))
    root = root or scratch_path(spark, tag)
    if kafka:
        q = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", kafka["servers"]).options(**kafka.get("options", {}))
             .option("topic", kafka["topic"]).option("checkpointLocation", f"{root}/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return None
    run_to_end(out, f"{tag}_{root[-12:]}", f"{root}/_checkpoint", fmt="text", path=f"{root}/data")
    return f"{root}/data"


def stream_train_then_score(spark: SparkSession, sf_dir: str, test_fraction: float = 0.2,
                            kafka_in: dict | None = None, kafka_out: dict | None = None, root: str | None = None,
                            source: DataFrame | None = None):
    """Land the train stream, fit OLS on the training part, score the held-out part of the stream.

    Malformed messages are landed with NULLs, and neither trained on nor scored.  ``root`` names a folder
    that keeps landed data, predictions and checkpoints: a restart goes on there and repeats nothing.
    Returns ``(model, folder_of_json_predictions)``.
    """
    src = source if source is not None else stream_source(spark, sf_dir, kafka_in, relation=True)
    if "event_id" not in src.columns:  # Kafka: hold out by the message offset instead
        src = src.withColumn("event_id", F.col("offset"))
    feats = stream_features(src).withColumn("_test", unit_hash("event_id") < F.lit(test_fraction))
    whole = F.col("y").isNotNull()
    for c in FEATURES:
        whole = whole & F.col(c).isNotNull()
    root = root or scratch_path(spark, "train_score")
    landed = land_stream(spark, feats.drop("features"), "train", f"{root}/train")
    train = spark.read.parquet(landed).filter(~F.col("_test") & whole)
    model = linear_fit(train, FEATURES, "y")
    scored = model.transform(feats.filter(F.col("_test") & whole))
    return model, json_sink(spark, scored, "predict", kafka_out, f"{root}/predict")


FOLD = 20  # micro-batches between two folded states
SUMS_SCHEMA = "dt date, score bigint, n_scores bigint, neg bigint, n_reviews bigint"


def _states(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the complete folded states and of the batches below ``path``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath() for f in fs.listStatus(root)] if fs.exists(root) else []
    done = [p.getName() for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    numbers = lambda kind: sorted(int(n.split("=")[1]) for n in done if n.startswith(f"{kind}="))
    return numbers("upto_id"), numbers("batch_id")


def read_daily_sums(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """Rows of sums below ``path``: the newest folded state and the batches after it, ``FOLD`` folders at most."""
    folded, batches = _states(spark, path)
    last = max((n for n in folded if before is None or n < before), default=-1)
    parts = [f"{path}/upto_id={last}"] if last >= 0 else []
    parts += [f"{path}/batch_id={n}" for n in batches if n > last and (before is None or n < before)]
    return spark.read.schema(SUMS_SCHEMA).parquet(*parts) if parts else None


def daily_sums(path: str):
    """``foreachBatch`` writer of mergeable per-day sums; batch n overwrites ``path/batch_id=n``.

    Every ``FOLD``-th batch adds all earlier sums to its own and writes them to ``path/upto_id=n``
    instead.  It reads the state before its own number only, and leaves that in place, so a replay after a failure
    gives the same rows; a state counts once its write is complete.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.groupBy("dt").agg(F.sum("score").alias("score"), F.count("score").alias("n_scores"), F.sum("neg").alias("neg"),
                                      F.count(F.lit(1)).alias("n_reviews"))
        if (batch_id + 1) % FOLD:
            own.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            return
        past = read_daily_sums(batch.sparkSession, path, before=batch_id)
        if past is not None:
            own = own.unionByName(past).groupBy("dt").agg(*[F.sum(c).alias(c) for c in ("score", "n_scores", "neg", "n_reviews")])
        own.write.mode("overwrite").parquet(f"{path}/upto_id={batch_id}")
    return write


def stream_daily_kpi(spark: SparkSession, sf_dir: str, max_files: int | None = None, glob: str = "orders.parquet",
                     root: str | None = None) -> DataFrame:
    """Daily mean score and negative share of a review stream, every day included.

    Each micro-batch leaves one row of sums per day, folded every ``FOLD`` batches; reading adds up the newest
    folded state and the batches after it, ``FOLD`` folders at most after any number of batches.  Late reviews and the
    newest day count, and the result does not depend on how the stream is cut into batches.
    ``root`` holds sums and checkpoint; a later call with it adds what is new.
    """
    o = file_source(spark, sf_dir, glob, ORDERS_SCHEMA, max_files)
    rv = o.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("score"),
                  F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("neg"),
                  F.to_date("o_orderdate").alias("dt"))
    root = root or scratch_path(spark, "daily_kpi")
    run_to_end(rv, f"daily_kpi_{root[-12:]}", f"{root}/_checkpoint", sink=daily_sums(f"{root}/data"))
    sums = read_daily_sums(spark, f"{root}/data")
    if sums is None:
        sums = spark.createDataFrame([], SUMS_SCHEMA)
    return (sums.groupBy("dt")
                 .agg((F.sum("score") / F.sum("n_scores")).alias("avg_score"), (F.sum("neg") / F.sum("n_reviews")).alias("neg_share"),
                      F.sum("n_reviews").alias("n_reviews")))


__all__ = ["train_records", "stream_source", "stream_features", "idempotent_append", "land_stream", "json_sink",
           "stream_sink_append", "stream_train_then_score", "stream_daily_kpi"]
