"""Registered queries for sources and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import cleaning as C
from ledgerlens.functions.datetime import fix_datetime
from ledgerlens.plans.registry import register
from ledgerlens.session import materialize, scratch_path
from ledgerlens.plans.sqlfixtures import clean_sql, fix_datetime_sql, hour24_sql, with_views
from ledgerlens.sources import files, ranges, tables

OUT_COLS = ["tranaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
            "tx_time_days", "tx_fraud", "tx_fraud_scenario", "source_file"]


def parsed(spark, sf_dir):
    return files.parse_transaction_lines(tables.tx_lines(spark, sf_dir))


def _clean_out(df):
    """Seconds are reported in whole seconds: the counter counts seconds, and a fitted value differs
    between two correct summation orders in its last bits (the original stored it as float32)."""
    return df.select(*[F.round("tx_time_seconds", 0).alias(c) if c == "tx_time_seconds" else F.col(c) for c in OUT_COLS])


_CLEAN_SELECT = ("SELECT tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, "
                 "round(tx_time_seconds, 0) AS tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario, source_file")


@register("clean_transactions", "2.2", sql=with_views("tx_parsed") + "," + clean_sql("tx_parsed")
          + f"\n{_CLEAN_SELECT} FROM c_out")
def q_clean_transactions(spark, sf_dir):
    """Flagship: raw text -> typed -> incomplete rows -> cap -> per-file outlier repair (input staged once)."""
    return _clean_out(C.clean_transactions(parsed(spark, sf_dir), stage=True))


# ------------------------------------------------------------------ 2.1 sources and sinks

TX_TYPED = ("tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days, "
            "tx_fraud, tx_fraud_scenario, source_file")


@register("read_transactions", "2.1", sql=with_views("tx_parsed") + f"\nSELECT {TX_TYPED} FROM tx_parsed")
def q_read_transactions(spark, sf_dir):
    path = scratch_path(spark, "tx_text")
    files.write_lines(tables.tx_lines_from_events(spark, sf_dir), path)
    return files.read_transactions(spark, path)


@register("header_columns", "2.1", sql=with_views("tx_lines") + """
SELECT source_file, CAST(generate_subscripts(arr, 1) AS INTEGER) AS position, trim(unnest(arr)) AS column_name
FROM (SELECT source_file, string_split(replace(value, '#', ''), '|') AS arr FROM tx_lines WHERE starts_with(value, '#'))""")
def q_header_columns(spark, sf_dir):
    """Column names from the first 4 KB of every text file."""
    lines = ranges.prefix_lines(spark, tables.tx_text(spark, sf_dir), 4096)
    return files.header_columns(lines).withColumn("position", F.col("position").cast("int"))


_HASH = "(CAST(('0x' || substr(md5({k}), 1, 8)) AS BIGINT) / 4294967296.0)"


@register("sample_rows", "2.1", sql=with_views("tx") + f"""
SELECT tranaction_id, source_file, tx_amount FROM tx WHERE {_HASH.format(k="CAST(tranaction_id AS VARCHAR)")} < 0.1""")
def q_sample_rows(spark, sf_dir):
    return files.sample_rows(tables.tx(spark, sf_dir), "tranaction_id", 0.1).select("tranaction_id", "source_file",
                                                                                    "tx_amount")


@register("write_clean", "2.1", sql=with_views("tx_parsed") + "," + clean_sql("tx_parsed")
          + f"\n{_CLEAN_SELECT} FROM c_out")
def q_write_clean(spark, sf_dir):
    """The whole file job: text files -> staged typed parquet -> cleaned -> one folder per source file."""
    src = scratch_path(spark, "tx_text")
    files.write_lines(tables.tx_lines_from_events(spark, sf_dir), src)
    return _clean_out(C.clean_files(spark, src, scratch_path(spark, "clean")))


@register("read_parquet", "2.1", sql=with_views("tx_parsed") + "," + clean_sql("tx_parsed")
          + "\nSELECT tranaction_id, tx_amount, source_file FROM c_out")
def q_read_parquet(spark, sf_dir):
    """All files of the written clean table."""
    path = scratch_path(spark, "clean")
    files.write_clean(C.clean_transactions(parsed(spark, sf_dir)), path)
    return files.read_parquet(spark, path).select("tranaction_id", "tx_amount", "source_file")


@register("load_table_csv", "2.1", sql=with_views("rt") + "\nSELECT score, source, dates, count FROM rt")
def q_load_table_csv(spark, sf_dir):
    path = scratch_path(spark, "rating_csv")
    files.write_table_csv(tables.rt(spark, sf_dir), path, sep=",")
    return files.load_table_csv(spark, path, files.RATING_SCHEMA, sep=",")


VEC_SUM_SQL = "round(list_sum(list_transform(embeddings, lambda x: CAST(x AS DOUBLE))), 6)"


def vec_sum(col):
    return F.round(F.aggregate(F.transform(col, lambda x: x.cast("double")), F.lit(0.0), lambda a, b: a + b), 6)


@register("load_vectors_csv", "2.1", sql=with_views("emb") + f"""
SELECT id, label, CAST(len(embeddings) AS INTEGER) AS dims, {VEC_SUM_SQL} AS vec_sum FROM emb""")
def q_load_vectors_csv(spark, sf_dir):
    """'|'-separated file with a ``[x,y,..]`` vector literal column, loaded back as ``array<float>``."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "vectors_csv")
    files.write_table_csv(tables.emb(spark, sf_dir), path, sep="|", vector_cols=("embeddings",))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("embeddings", T.StringType()),
                           T.StructField("label", T.IntegerType())])
    df = files.load_table_csv(spark, path, schema, sep="|", vector_cols=("embeddings",))
    return df.select("id", "label", F.size("embeddings").alias("dims"), vec_sum(F.col("embeddings")).alias("vec_sum"))


@register("load_reviews_csv", "2.1", sql=with_views("docs") + """
SELECT nullif(content, '') AS content, CAST(id % 5 + 1 AS INTEGER) AS score, country, source FROM docs""")
def q_load_reviews_csv(spark, sf_dir):
    """Whole reviews written as '|'-separated text and loaded back: quotes, separators and line breaks in the
    content survive, and the fixed-width columns lose their padding.  The format does not tell an empty text from none."""
    path = scratch_path(spark, "reviews_csv")
    d = tables.docs(spark, sf_dir).select(
        "content", (F.col("id") % 5 + 1).cast("int").alias("score"), F.lit(None).cast("timestamp_ntz").alias("created_time"),
        "country", F.rpad("source", 20, " ").alias("source"), F.lit(None).cast("string").alias("sentiment"),
        F.lit(None).cast("string").alias("embeddings"))
    files.write_table_csv(d, path, sep="|")
    r = files.load_table_csv(spark, path, files.REVIEWS_SCHEMA, sep="|", vector_cols=("embeddings",))
    return r.select("content", "score", "country", "source")


@register("append_table", "2.1", sql=with_views("rt") + "\nSELECT score, source, dates, count FROM rt")
def q_append_table(spark, sf_dir):
    path = scratch_path(spark, "rating_table")
    r = tables.rt(spark, sf_dir)
    for src in tables.SOURCES:  # one append per daily load, as the rating job did
        files.append_table(r.filter(F.col("source") == src), path)
    return files.read_parquet(spark, path)


@register("read_table", "2.1", sql=with_views("docs") + "\nSELECT id, content FROM docs")
def q_read_table(spark, sf_dir):
    tables.docs(spark, sf_dir).createOrReplaceTempView("reviews")
    return spark.sql("SELECT id, content FROM reviews")


# ------------------------------------------------------------------ 2.2 cleaning

@register("safe_cast", "2.2", sql=with_views("tx_lines") + """
SELECT source_file, f[1] AS raw_id, TRY_CAST(trim(f[1]) AS BIGINT) AS tranaction_id,
       f[5] AS raw_amount, TRY_CAST(trim(f[5]) AS DOUBLE) AS tx_amount
FROM (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#'))""")
def q_safe_cast(spark, sf_dir):
    lines = tables.tx_lines(spark, sf_dir).filter(~F.col("value").startswith("#"))
    f = lines.select("source_file", F.split("value", ",").alias("f"))
    raw = f.select("source_file", F.get("f", 0).alias("raw_id"), F.get("f", 4).alias("raw_amount"))
    typed = C.safe_cast(raw.withColumn("tranaction_id", F.col("raw_id")).withColumn("tx_amount", F.col("raw_amount")),
                        {"tranaction_id": "bigint", "tx_amount": "double"})
    return typed.select("source_file", "raw_id", "tranaction_id", "raw_amount", "tx_amount")


@register("fix_datetime", "2.2", sql=with_views("tx_lines") + f"""
SELECT source_file, f[1] AS raw_id, f[2] AS raw_datetime, {fix_datetime_sql('f[2]')} AS tx_datetime
FROM (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#'))""")
def q_fix_datetime(spark, sf_dir):
    lines = tables.tx_lines(spark, sf_dir).filter(~F.col("value").startswith("#"))
    f = lines.select("source_file", F.split("value", ",").alias("f"))
    raw = f.select("source_file", F.get("f", 0).alias("raw_id"), F.get("f", 1).alias("raw_datetime"))
    return raw.withColumn("tx_datetime", fix_datetime("raw_datetime"))


def _shift_all_sql(text: str) -> str:
    """The original job's rule written out: hour 24 -> 23, then one hour added to every row."""
    s = f"regexp_replace(trim({text}), '\\s+', ' ', 'g')"
    rx = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"
    y, mo, d, h, mi, se = [f"TRY_CAST(regexp_extract({s}, '{rx}', {i}) AS INTEGER)" for i in range(1, 7)]
    return (f"CASE WHEN {se} < 60 THEN try(make_timestamp({y}, {mo}, {d}, CASE WHEN {h} = 24 THEN 23 ELSE {h} END, "
            f"{mi}, {se})) + INTERVAL 1 HOUR END")


@register("fix_datetime_shift_all", "2.2", sql=with_views("tx_lines") + f"""
SELECT source_file, f[1] AS raw_id, {_shift_all_sql('f[2]')} AS tx_datetime
FROM (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#'))""")
def q_fix_datetime_shift_all(spark, sf_dir):
    """The original job's behaviour, kept as an option: every row moves one hour."""
    lines = tables.tx_lines(spark, sf_dir).filter(~F.col("value").startswith("#"))
    f = lines.select("source_file", F.split("value", ",").alias("f"))
    return f.select("source_file", F.get("f", 0).alias("raw_id"), fix_datetime(F.get("f", 1), shift_all=True).alias("tx_datetime"))


@register("fix_datetime_report", "2.2", sql=with_views("tx_lines") + f"""
SELECT source_file, count(*) AS n_rows, count(*) FILTER (WHERE fixed IS NULL) AS n_bad,
       count(*) FILTER (WHERE fixed IS NOT NULL AND coalesce(h24, FALSE)) AS n_repaired,
       count(*) FILTER (WHERE fixed IS NULL) + count(*) FILTER (WHERE fixed IS NOT NULL AND coalesce(h24, FALSE)) AS n_defects
FROM (SELECT source_file, {fix_datetime_sql('f[2]')} AS fixed, {hour24_sql('f[2]')} AS h24
      FROM (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#')))
GROUP BY source_file""")
def q_fix_datetime_report(spark, sf_dir):
    return C.fix_datetime_report(tables.tx_lines(spark, sf_dir))


_PARSED_INC = clean_sql("tx_parsed").split("c_cap AS")[0].rstrip().rstrip(",")


@register("drop_incomplete", "2.2", sql=with_views("tx_parsed") + "," + _PARSED_INC + f"\nSELECT {TX_TYPED} FROM c_inc")
def q_drop_incomplete(spark, sf_dir):
    p = parsed(spark, sf_dir)
    return C.drop_incomplete(p, 2, [c for c in p.columns if c != "source_file"])


@register("not_null_filter", "2.2", sql=with_views("tx_parsed") + f"""
SELECT {TX_TYPED} FROM tx_parsed WHERE tx_amount IS NOT NULL AND tx_time_seconds IS NOT NULL""")
def q_not_null_filter(spark, sf_dir):
    return C.not_null_filter(parsed(spark, sf_dir))


@register("cap_amount", "2.2", sql=with_views("tx_parsed") + """
SELECT tranaction_id, source_file, CASE WHEN tx_amount > 131.45 THEN 131.45 ELSE tx_amount END AS tx_amount FROM tx_parsed""")
def q_cap_amount(spark, sf_dir):
    return C.cap_amount(parsed(spark, sf_dir)).select("tranaction_id", "source_file", "tx_amount")


@register("time_outliers", "2.2", sql=with_views("tx_parsed") + "," + clean_sql("tx_parsed", cap=1e300)
          + f"\n{_CLEAN_SELECT} FROM c_out")
def q_time_outliers(spark, sf_dir):
    """One-sided replace (the original job) after dropping incomplete rows, without the amount cap."""
    p = parsed(spark, sf_dir)
    p = C.drop_incomplete(p, 2, [c for c in p.columns if c != "source_file"])
    return _clean_out(C.time_outliers(materialize(p, "outlier_input")))


@register("time_outliers_drop", "2.2", sql=with_views("tx_parsed") + "," +
          clean_sql("tx_parsed", two_sided=True, action="drop") + f"\n{_CLEAN_SELECT} FROM c_out")
def q_time_outliers_drop(spark, sf_dir):
    """The notebook's variant: two-sided border, outlier rows removed."""
    return _clean_out(C.clean_transactions(parsed(spark, sf_dir), two_sided=True, action="drop"))


@register("select_rename_drop", "2.2", sql=with_views("rv") + """
SELECT id, score, created_time AS at, source, 'reviews' AS dataset FROM rv""")
def q_select_rename_drop(spark, sf_dir):
    return C.select_rename_drop(tables.rv(spark, sf_dir), keep=["id", "score", "created_time", "source", "country"],
                                rename={"created_time": "at"}, drop=["country"], constants={"dataset": "reviews"})


AS_OF = "1998-08-02"


@register("filter_day", "2.2", sql=with_views("rv") + f"""
SELECT id, score, source FROM rv WHERE CAST(created_time AS DATE) = DATE '{AS_OF}'""")
def q_filter_day(spark, sf_dir):
    return C.filter_day(tables.rv(spark, sf_dir), "created_time", AS_OF).select("id", "score", "source")


@register("coverage_check", "2.2", sql=with_views("rv") + """
SELECT source, min(created_time) AS oldest, count(*) AS n_rows, min(created_time) < TIMESTAMP '1995-01-05 00:00:00' AS covered
FROM rv GROUP BY source""")
def q_coverage_check(spark, sf_dir):
    return C.coverage_check(tables.rv(spark, sf_dir), "1995-01-05 00:00:00")


@register("map_labels", "2.2", sql="""
SELECT doc_id, quality + toxic AS class_id,
       CASE quality + toxic WHEN 0 THEN 'NEUTRAL' WHEN 1 THEN 'POSITIVE' WHEN 2 THEN 'NEGATIVE' END AS sentiment
FROM labels""")
def q_map_labels(spark, sf_dir):
    lab = tables.load(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + F.col("toxic")).alias("class_id"))
    return C.map_labels(lab, "class_id")


STREAM_X_SQL = "[value, CAST(json_extract_string(props, '$.k') AS DOUBLE), CAST(hour(ts) AS DOUBLE)]"


@register("array_to_columns", "2.2", sql=f"""
SELECT event_id, X[1] AS X1, X[2] AS X2, X[3] AS X3, X[4] AS X4 FROM (SELECT event_id, {STREAM_X_SQL} AS X FROM events)""")
def q_array_to_columns(spark, sf_dir):
    """``X[i] -> Xi``; X4 is past the end of the 3-element array and comes out NULL."""
    from ledgerlens.streaming.jobs import train_records
    rec = train_records(tables.load(spark, sf_dir, "events"), parsed_only=True)
    return C.array_to_columns(rec, "X", 4).select("event_id", "X1", "X2", "X3", "X4")


@register("parse_json", "2.2", sql=f"""
SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS y, X[1] AS X1, X[2] AS X2, X[3] AS X3 FROM (SELECT event_id, value, {STREAM_X_SQL} AS X FROM events)""")
def q_parse_json(spark, sf_dir):
    """JSON train records (as Kafka would carry them, in binary) parsed back by schema."""
    from ledgerlens.streaming.jobs import train_records
    rec = train_records(tables.load(spark, sf_dir, "events"))
    p = C.parse_json(rec, "value")
    return p.select("event_id", F.col("raw_data.y").cast("double").alias("y"),
                    *[F.get(F.col("raw_data.X"), i).alias(f"X{i + 1}") for i in range(3)])


@register("format_json", "2.2", sql="SELECT CAST(to_json({'y': value, 'prediction': value * 2}) AS VARCHAR) AS value FROM events")
def q_format_json(spark, sf_dir):
    ev = tables.load(spark, sf_dir, "events").select(F.col("value").alias("y"), (F.col("value") * 2).alias("prediction"))
    return C.format_json(ev, ["y", "prediction"])
