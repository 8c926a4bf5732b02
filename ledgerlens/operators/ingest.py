"""Review ingest as one job: day filter, dedup, history check, sentiment, embedding, upsert.

The store is a folder with one ``reviews`` and one ``filters`` folder per day.  A text is known by its SHA-256.  The
day's new texts are first tested against a Bloom filter: the union of all earlier days' filters, then, for the few that pass,
each day's own.  Only days that some text may belong to are read for the exact anti-join, and only if there are any.
A day's two folders are replaced as a whole, and only earlier days are looked at, so running a day again changes
nothing, and a text that an earlier day holds is not stored again.

A filter is ``bits`` bits in bitmaps of 32,768 bits (4 KB rows), made by an aggregate with partial maps; more texts than
it is made for only let more days be read.  Texts meet filters by bitmap number, one row per hash, so the day's texts are
shuffled, never the history's.

Defined results: rows without a text or a time are left out; copies keep the smallest (rank, id); days must be loaded in
order for the history to be complete (an earlier day loaded later does not look at later ones).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning as C
from ledgerlens.operators import text as T
from ledgerlens.session import materialize

BITS = 1 << 24
HASHES = 4
Step = Callable[[DataFrame], DataFrame]


def positions(sha: str | Column, bits: int) -> Column:
    """The bits of a text's digest in a filter."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), sha), F.lit(bits)) for i in range(HASHES)])


def build_filter(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the digests ``sha``."""
    at = rows.select(F.explode(positions("sha", bits)).alias("p"))
    return at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))


def _is_set(bitmap: Column, p: Column) -> Column:
    bit = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.call_function("substring", bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def may_hold(rows: DataFrame, filters: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs (sha, day) whose bits are all set in the day's filter; ``filters`` has day, bucket, bitmap."""
    at = rows.select("sha", F.explode(positions("sha", bits)).alias("p")).distinct().withColumn("bucket", F.bitmap_bucket_number("p"))
    wanted = at.groupBy(F.col("sha").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))  # two hashes may meet in one bit
    hits = (at.join(filters, "bucket").where(_is_set(F.col("bitmap"), F.col("p"))).groupBy("sha", "day").agg(F.count(F.lit(1)).alias("n")))
    return hits.join(wanted, (F.col("sha") == F.col("_s")) & (F.col("n") == F.col("_n"))).select("sha", "day")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def known_texts(spark: SparkSession, store: str, rows: DataFrame, day: str, bits: int = BITS) -> tuple[DataFrame | None, list[str]]:
    """Digests of ``rows`` that an earlier day holds (None: there is none), and the days that were read for it."""
    filters = _stored(spark, f"{store}/filters")
    if filters is None:
        return None, []
    earlier = filters.where(F.col("day") < F.lit(day).cast(filters.schema["day"].dataType)).withColumn("day", F.col("day").cast("string"))
    union = earlier.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")).withColumn("day", F.lit("all"))
    some = materialize(may_hold(rows, union, bits).select("sha"), "ingest_may_hold")
    found = materialize(may_hold(some, earlier, bits), "ingest_candidates")
    days = sorted(r["day"] for r in found.select("day").distinct().collect())  # one row per stored day at most
    if not days:
        return None, []
    history = spark.read.parquet(*[f"{store}/reviews/day={d}" for d in days]).select("sha")  # no other day is opened
    return history.join(found.select("sha").distinct(), "sha", "left_semi").distinct(), days


def ingest_day(spark: SparkSession, frames: list[tuple[DataFrame, dict]], store: str, day: str, enrich: list[Step] = (), bits: int = BITS) -> list[str]:
    """Load one day of the tagged source ``frames`` into ``store``; returns the earlier days that were read.

    Frames have id, content, created_time and source_rank; ``enrich`` steps (sentiment, embedding) see only texts that
    will be stored.
    """
    rows = T.union_sources(frames).where(F.col("content").isNotNull())
    new = T.dedup_content(C.filter_day(rows, "created_time", day)).withColumn("sha", F.sha2("content", 256))
    new = materialize(new, "ingest_new")
    known, days = known_texts(spark, store, new, day, bits)
    kept = new if known is None else new.join(known, "sha", "left_anti")
    for step in enrich:
        kept = step(kept)
    kept = materialize(kept, "ingest_kept")
    build_filter(kept, bits).write.mode("overwrite").parquet(f"{store}/filters/day={day}")
    kept.write.mode("overwrite").parquet(f"{store}/reviews/day={day}")
    return days
