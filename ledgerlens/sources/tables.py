"""Driver tables and the domain views built on them (see FIXTURES.md).

* ``tx``        typed transactions from ``events``
* ``tx_lines``  the same transactions as raw text lines with a ``# a | b`` header per file,
                with deterministic defects (hour 24, malformed dates, blanks, bad ids, shifted seconds)
* ``rv``        reviews from ``orders``; ``rt`` daily rating per source from ``rv``
* ``docs``      review texts from ``documents``; ``emb`` embeddings

Every view is a projection of a parquet scan, so Catalyst prunes columns and
pushes filters into the scan of the underlying table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.datetime import DAY_SECONDS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# The transaction columns in file order (the id keeps the original spelling).
TX_COLUMNS = ("tranaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount",
              "tx_time_seconds", "tx_time_days", "tx_fraud", "tx_fraud_scenario")

# Fixture rules (shared with the DuckDB oracle): which event ids get which defect.
N_FILES = 4
TX_EPOCH = "2024-01-01 00:00:00"
DEFECTS = {
    "bad_id": (83, 1),        # id text is not a number
    "hour_only": (97, 5),     # datetime text is just the hour, e.g. '23'
    "date_only": (61, 4),     # datetime text has one part
    "hour_24": (3, 0),        # among rows at hour 00: written as hour 24 of the day before
    "blank_amount": (89, 3),  # empty amount field
    "shifted": (101, 7),      # seconds pushed far off the line
    "sparse": (113, 9),       # only the id is present
}
SHIFT_SECONDS = 40_000_000
DRIFT_FILE = N_FILES - 1      # this file's header spells the id column 'transaction_id'


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _defect(name: str):
    m, r = DEFECTS[name]
    return (F.col("event_id") % m) == r


def source_file_col(event_id="event_id"):
    return F.concat(F.lit("tx_"), (F.col(event_id) % N_FILES).cast("string"), F.lit(".txt"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions (clean) with their source file tag."""
    ev = load(spark, sf_dir, "events")
    secs = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{TX_EPOCH}', ts)")
    fraud = (F.col("event_type") == "error").cast("int")
    return ev.select(
        F.col("event_id").alias("tranaction_id"),
        F.col("ts").alias("tx_datetime"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("terminal_id"),
        F.col("value").alias("tx_amount"),
        secs.cast("double").alias("tx_time_seconds"),
        F.floor(secs / DAY_SECONDS).cast("int").alias("tx_time_days"),
        fraud.alias("tx_fraud"),
        F.when(fraud == 1, 1 + F.col("user_id") % 3).otherwise(0).cast("int").alias("tx_fraud_scenario"),
        source_file_col().alias("source_file"),
    )


def header_line(drift: bool) -> str:
    names = list(TX_COLUMNS)
    if drift:
        names[0] = "transaction_id"
    return "# " + " | ".join(names)


_TEXT_FILES: dict[tuple[str, str], str] = {}


def tx_text(spark: SparkSession, sf_dir: str) -> str:
    """The folder of raw transaction text files.

    The text is generated from ``events`` (``tx_lines_from_events``) and written once per
    application and data folder as one text folder per source file below the shared
    checkpoint root; later calls read the same files.  Reading real files keeps the parser
    working on a scanned column, as it does on the production bucket.
    """
    from ledgerlens.session import scratch_path
    from ledgerlens.sources.files import write_lines
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _TEXT_FILES.get(key)
    if path is None:
        path = scratch_path(spark, "tx_text")
        write_lines(tx_lines_from_events(spark, sf_dir), path)
        _TEXT_FILES[key] = path
    return path


def tx_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction text files, as ``(source_file, value)`` lines."""
    from ledgerlens.sources.files import read_lines
    return read_lines(spark, tx_text(spark, sf_dir))


def tx_lines_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction text: ``(source_file, value)``, one header line per file plus one line per event."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    secs = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{TX_EPOCH}', ts)")
    cents = F.round(F.col("value") * 100).cast("bigint")
    amount_txt = F.concat((cents / 100).cast("bigint").cast("string"), F.lit("."),
                          F.lpad((cents % 100).cast("string"), 2, "0"))
    dt_txt = (F.when(_defect("hour_only"), F.date_format("ts", "HH"))
               .when(_defect("date_only"), F.date_format("ts", "yyyy-MM-dd"))
               .when((F.hour("ts") == 0) & _defect("hour_24"),
                     F.concat(F.date_format(F.date_sub(F.to_date("ts"), 1), "yyyy-MM-dd"), F.lit(" 24:"),
                              F.date_format("ts", "mm:ss")))
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    id_txt = F.when(_defect("bad_id"), F.concat(F.lit("x"), F.col("event_id").cast("string"))) \
              .otherwise(F.col("event_id").cast("string"))
    secs_txt = (secs + F.when(_defect("shifted"), F.lit(SHIFT_SECONDS)).otherwise(F.lit(0))).cast("string")
    fraud = (F.col("event_type") == "error").cast("int")
    fields = [
        id_txt,
        dt_txt,
        F.col("user_id").cast("string"),
        F.get_json_object("props", "$.k"),
        F.when(_defect("blank_amount"), F.lit("")).otherwise(amount_txt),
        secs_txt,
        F.floor(secs / DAY_SECONDS).cast("string"),
        fraud.cast("string"),
        F.when(fraud == 1, 1 + F.col("user_id") % 3).otherwise(0).cast("string"),
    ]
    line = F.when(_defect("sparse"), F.concat(id_txt, F.lit("," * 8))).otherwise(F.concat_ws(",", *fields))
    body = ev.select(source_file_col().alias("source_file"), line.alias("value"))
    # one header per file that has rows; the file set comes from the data, not a fixed list
    files = ev.select((F.col("event_id") % N_FILES).alias("k")).distinct()
    headers = files.select(
        F.concat(F.lit("tx_"), F.col("k").cast("string"), F.lit(".txt")).alias("source_file"),
        F.when(F.col("k") == DRIFT_FILE, F.lit(header_line(True))).otherwise(F.lit(header_line(False))).alias("value"),
    )
    return headers.unionByName(body)


# Review view mappings (order status F -> NEGATIVE, O -> POSITIVE, else NEUTRAL).
COUNTRIES = ("ru", "kz", "by")
SOURCES = ("GooglePlay", "AppStore")  # o_custkey % 2 == 0 -> GooglePlay


def rv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews: id, score 1-5, created_time, country, source, sentiment."""
    o = load(spark, sf_dir, "orders")
    sentiment = F.when(F.col("o_orderstatus") == "F", "NEGATIVE") \
                 .when(F.col("o_orderstatus") == "O", "POSITIVE").otherwise("NEUTRAL")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("score"),
        F.col("o_orderdate").alias("created_time"),
        F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), (F.col("o_custkey") % 3 + 1).cast("int")).alias("country"),
        F.when(F.col("o_custkey") % 2 == 0, SOURCES[0]).otherwise(SOURCES[1]).alias("source"),
        sentiment.alias("sentiment"),
    )


def rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily rating per source: score (mean), source, dates, count."""
    r = rv(spark, sf_dir)
    return (r.groupBy("source", F.to_date("created_time").alias("dates"))
             .agg(F.avg("score").alias("score"), F.count(F.lit(1)).cast("int").alias("count"))
             .select("score", "source", "dates", "count"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.col("text").alias("content"),
                    F.col("lang").alias("country"), "source")


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("embeddings"), "label")
