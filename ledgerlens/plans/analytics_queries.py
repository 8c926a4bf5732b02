"""Registered queries for profiling, KPIs, day-over-day and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.datetime import DAY_MICROS
from ledgerlens.operators import cleaning as C
from ledgerlens.operators import features as FE
from ledgerlens.operators import kpi as K
from ledgerlens.operators import profile as P
from ledgerlens.plans.registry import register
from ledgerlens.session import materialize
from ledgerlens.plans.sqlfixtures import clean_sql, fix_datetime_sql, with_views
from ledgerlens.sources import files, tables
from ledgerlens.sources.tables import TX_COLUMNS

AS_OF = "1998-08-02"


def rd(x: str, digits: int = 2) -> str:
    """SQL twin of ``kpi.round_half_up``."""
    return f"CAST(round(CAST({x} AS DECIMAL(24,10)), {digits}) AS DOUBLE)"


def pct_sql(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(24,10)) * 100, 0) AS INTEGER)"


def parsed(spark, sf_dir):
    return files.parse_transaction_lines(tables.tx_lines(spark, sf_dir))


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


# ------------------------------------------------------------------ 2.4 profiling

_NUM = ("tx_amount", "tx_time_seconds")


def _missing_sql(c):
    return f"({c} IS NULL OR isnan({c}))" if c in _NUM else f"({c} IS NULL)"


_PROFILE_SQL = with_views("tx_parsed") + ",\nper AS (" + "\nUNION ALL\n".join(
    f"SELECT source_file, '{c}' AS column_name, count(*) AS nrows, count(*) FILTER (WHERE {_missing_sql(c)}) AS na "
    f"FROM tx_parsed GROUP BY source_file" for c in TX_COLUMNS) + """)
SELECT source_file, column_name, nrows, na, round(na / nrows, 6) AS pct_na FROM per
UNION ALL
SELECT '*', column_name, CAST(sum(nrows) AS BIGINT), CAST(sum(na) AS BIGINT), round(sum(na) / sum(nrows), 6) FROM per GROUP BY column_name"""


@register("column_profile", "2.4", sql=_PROFILE_SQL)
def q_column_profile(spark, sf_dir):
    return r6(P.column_profile(parsed(spark, sf_dir)), "pct_na").select("source_file", "column_name", "nrows", "na", "pct_na")


_KIND = ("CASE WHEN {x} IS NULL OR trim({x}) = '' THEN 1 WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN 0 "
         "WHEN TRY_CAST(trim({x}) AS DOUBLE) IS NOT NULL THEN 1 ELSE 2 END")
_HDR_SQL = """SELECT source_file, CAST(generate_subscripts(arr, 1) AS INTEGER) AS position, trim(unnest(arr)) AS column_name
FROM (SELECT source_file, string_split(replace(value, '#', ''), '|') AS arr FROM tx_lines WHERE starts_with(value, '#'))"""

_DRIFT_SQL = with_views("tx_lines") + """,
body AS (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#')),
kl AS (""" + "\nUNION ALL\n".join(
    f"SELECT source_file, {i + 1} AS position, max({_KIND.format(x=f'f[{i + 1}]')}) AS k FROM body GROUP BY source_file"
    for i in range(len(TX_COLUMNS))) + f"""),
hdr AS ({_HDR_SQL}),
typed AS (SELECT hdr.column_name, hdr.source_file,
                 CASE kl.k WHEN 0 THEN 'int64' WHEN 1 THEN 'float64' WHEN 2 THEN 'object' END AS dtype
          FROM hdr LEFT JOIN kl USING (source_file, position)),
allf AS (SELECT list(DISTINCT source_file) AS files FROM hdr)
SELECT column_name, array_to_string(list_sort(list_distinct(list(dtype) FILTER (WHERE dtype IS NOT NULL))), ',') AS dtypes,
       count(*) AS n_files,
       array_to_string(list_sort(list_filter(any_value(allf.files), lambda x: NOT list_contains(list(typed.source_file), x))), ',') AS absent_in
FROM typed, allf GROUP BY column_name"""


@register("schema_drift", "2.4", sql=_DRIFT_SQL)
def q_schema_drift(spark, sf_dir):
    return P.schema_drift(tables.tx_lines(spark, sf_dir))


_DT_RE = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"
_PARTS_SQL = (f"CASE WHEN regexp_matches(s, '{_DT_RE}') THEN "
              "list_transform(string_split_regex(s, '[- :]'), lambda x: TRY_CAST(x AS INTEGER)) END")
_DOMAIN_SQL = with_views("tx_lines") + f""",
b AS (SELECT source_file, {_PARTS_SQL} AS dt FROM (
        SELECT source_file, regexp_replace(trim(string_split(value, ',')[2]), '\\s+', ' ', 'g') AS s
        FROM tx_lines WHERE NOT starts_with(value, '#')))
""" + "\nUNION ALL\n".join(
    f"SELECT source_file, '{p}' AS part, "
    f"array_to_string(list_sort(list_distinct(list(dt[{i + 1}]) FILTER (WHERE dt[{i + 1}] IS NOT NULL))), ',') AS distinct_values, "
    f"min(dt[{i + 1}]) AS min_value, max(dt[{i + 1}]) AS max_value, count(*) FILTER (WHERE dt IS NULL) AS n_bad "
    f"FROM b GROUP BY source_file" for i, p in enumerate(P.DT_PARTS))


@register("datetime_domain", "2.4", sql=_DOMAIN_SQL)
def q_datetime_domain(spark, sf_dir):
    return P.datetime_domain(tables.tx_lines(spark, sf_dir))


@register("datetime_bad_values", "2.4", sql=with_views("tx_lines") + f"""
SELECT source_file, f[2] AS text, count(*) AS n
FROM (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#'))
WHERE ({fix_datetime_sql('f[2]')}) IS NULL GROUP BY 1, 2""")
def q_datetime_bad_values(spark, sf_dir):
    """The unparseable datetime texts per file with their counts (rows, not a list on the driver)."""
    return P.datetime_bad_values(tables.tx_lines(spark, sf_dir))


@register("box_stats", "2.4", sql=with_views("tx") + """,
q AS (SELECT source_file, quantile_cont(tx_amount, [0.25, 0.5, 0.75]) AS qs FROM tx GROUP BY source_file),
q2 AS (SELECT source_file, qs[1] AS q1, qs[2] AS median, qs[3] AS q3,
              qs[1] - 1.5 * (qs[3] - qs[1]) AS lo, qs[3] + 1.5 * (qs[3] - qs[1]) AS hi FROM q)
SELECT source_file, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(tx_amount) FILTER (WHERE tx_amount BETWEEN lo AND hi) AS whisker_low,
       max(tx_amount) FILTER (WHERE tx_amount BETWEEN lo AND hi) AS whisker_high,
       count(*) FILTER (WHERE NOT (tx_amount BETWEEN lo AND hi)) AS n_outliers
FROM tx JOIN q2 USING (source_file) WHERE tx_amount IS NOT NULL
GROUP BY source_file, q1, median, q3""")
def q_box_stats(spark, sf_dir):
    return r6(P.box_stats(tables.tx(spark, sf_dir)), "q1", "median", "q3")


@register("value_share", "2.4", sql=with_views("tx") + """
SELECT source_file, tx_fraud_scenario, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY source_file), 6) AS share
FROM tx GROUP BY source_file, tx_fraud_scenario""")
def q_value_share(spark, sf_dir):
    return r6(P.value_share(tables.tx(spark, sf_dir), "tx_fraud_scenario"), "share")


@register("histogram", "2.4", sql=with_views("tx") + """,
s AS (SELECT source_file, epoch_us(tx_datetime) // 1000000 AS s FROM tx WHERE tx_datetime IS NOT NULL),
r AS (SELECT source_file, min(s) AS lo, max(s) AS hi FROM s GROUP BY source_file),
b AS (SELECT source_file, lo, hi, CAST(least(floor((s - lo) * 99 / greatest(hi - lo, 1)) + 1, 99) AS INTEGER) AS bin
      FROM s JOIN r USING (source_file))
SELECT source_file, bin, count(*) AS n, round(lo + (bin - 1) * (hi - lo) / 99, 3) AS bin_start
FROM b GROUP BY source_file, bin, lo, hi""")
def q_histogram(spark, sf_dir):
    h = P.histogram(tables.tx(spark, sf_dir))
    return h.withColumn("bin_start", F.round("bin_start", 3))  # epoch seconds: 3 decimals is double precision


_DAILY_P_SQL = """daily AS (
  SELECT source_file, CAST(tx_datetime AS DATE) AS date, quantile_cont(tx_amount, [0.05, 0.5, 0.95]) AS q
  FROM tx_parsed WHERE tx_amount IS NOT NULL AND tx_time_seconds IS NOT NULL AND tx_datetime IS NOT NULL
  GROUP BY source_file, CAST(tx_datetime AS DATE))"""


@register("daily_percentiles", "2.4", sql=with_views("tx_parsed") + ",\n" + _DAILY_P_SQL + """
SELECT source_file, date, round(q[1], 6) AS amount_lower, round(q[2], 6) AS amount_median, round(q[3], 6) AS amount_higher
FROM daily""")
def q_daily_percentiles(spark, sf_dir):
    return r6(P.daily_percentiles(parsed(spark, sf_dir)), "amount_lower", "amount_median", "amount_higher")


@register("robust_cap", "2.4", sql=with_views("tx_parsed") + ",\n" + _DAILY_P_SQL + """
SELECT date, round(median(q[3]), 6) AS median_p95, round((SELECT median(q[3]) FROM daily), 6) AS cap
FROM daily GROUP BY date""")
def q_robust_cap(spark, sf_dir):
    return r6(P.robust_cap(P.daily_percentiles(parsed(spark, sf_dir))), "median_p95", "cap")


@register("residual_std", "2.4", sql=with_views("tx_parsed") + "," + clean_sql("tx_parsed", cap=1e300).split("c_res2 AS")[0].rstrip().rstrip(",") + """
SELECT source_file, round(_sd, 0) AS sigma FROM c_sd""")
def q_residual_std(spark, sf_dir):
    p = parsed(spark, sf_dir)
    p = C.drop_incomplete(p, 2, [c for c in p.columns if c != "source_file"])
    f = C.outlier_flags(materialize(p, "residual_input"))
    # σ of residual seconds, in whole seconds (see cleaning_queries._clean_out)
    return f.groupBy("source_file").agg(F.round(F.stddev_samp("residual"), 0).alias("sigma"))


# ------------------------------------------------------------------ 2.4 review KPIs

_UPTO = f"CAST(created_time AS DATE) <= DATE '{AS_OF}'"


@register("avg_score", "2.4", sql=with_views("rv") + f"\nSELECT {rd("avg(score)")} AS avg_score FROM rv WHERE {_UPTO}")
def q_avg_score(spark, sf_dir):
    return K.avg_score(tables.rv(spark, sf_dir), AS_OF)


@register("neg_share", "2.4", sql=with_views("rv") + f"""
SELECT {pct_sql("avg(CASE WHEN sentiment = 'NEGATIVE' THEN 1 ELSE 0 END)")} AS neg_pct FROM rv WHERE {_UPTO}""")
def q_neg_share(spark, sf_dir):
    return K.neg_share(tables.rv(spark, sf_dir), AS_OF)


@register("score_histogram", "2.4", sql=with_views("rv") + "\nSELECT " + ", ".join(
    f"count(*) FILTER (WHERE score = {s}) AS n_{s}" for s in range(1, 6)) + f" FROM rv WHERE {_UPTO}")
def q_score_histogram(spark, sf_dir):
    return K.score_histogram(tables.rv(spark, sf_dir), AS_OF)


@register("score_histogram_midnight", "2.4", sql=with_views("rv") + "\nSELECT " + ", ".join(
    f"count(*) FILTER (WHERE score = {s}) AS n_{s}" for s in range(1, 6)) + f" FROM rv WHERE created_time <= TIMESTAMP '{AS_OF} 00:00:00'")
def q_score_histogram_midnight(spark, sf_dir):
    """The original histogram filter, ``created_time <= midnight of the date``."""
    return K.score_histogram(tables.rv(spark, sf_dir), AS_OF, inclusive=False)


_LAST30 = f"CAST(created_time AS DATE) <= DATE '{AS_OF}' AND CAST(created_time AS DATE) > DATE '{AS_OF}' - 30"


@register("daily_rating", "2.4", sql=with_views("rv") + f"""
SELECT CAST(created_time AS DATE) AS dt, {rd("avg(score)")} AS avg_score FROM rv WHERE {_LAST30} GROUP BY 1 ORDER BY 1""")
def q_daily_rating(spark, sf_dir):
    return K.daily_rating(tables.rv(spark, sf_dir), AS_OF)


@register("daily_neg", "2.4", sql=with_views("rv") + f"""
SELECT CAST(created_time AS DATE) AS dt, {pct_sql("avg(CASE WHEN sentiment = 'NEGATIVE' THEN 1 ELSE 0 END)")} AS neg_pct
FROM rv WHERE {_LAST30} GROUP BY 1 ORDER BY 1""")
def q_daily_neg(spark, sf_dir):
    return K.daily_neg(tables.rv(spark, sf_dir), AS_OF)


@register("source_score", "2.4", sql=with_views("rt") + f"""
SELECT source, {rd("avg(score)")} AS avg_score FROM rt WHERE dates <= DATE '{AS_OF}' GROUP BY source""")
def q_source_score(spark, sf_dir):
    return K.source_score(tables.rt(spark, sf_dir), AS_OF)


@register("weighted_rating", "2.4", sql=with_views("rv") + """
SELECT source, round(sum(score) / count(*), 6) AS score, count(*) AS count FROM rv GROUP BY source""")
def q_weighted_rating(spark, sf_dir):
    return r6(K.weighted_rating(K.star_histogram(tables.rv(spark, sf_dir))), "score")


# ------------------------------------------------------------------ 2.3 scalar joins, 2.5 day over day

def _change_sql(value: str, src: str = "rv", day: str = "CAST(created_time AS DATE)", extra: str = "") -> str:
    return f"""today AS (SELECT avg({value}) AS t FROM {src} WHERE {day} = DATE '{AS_OF}' {extra}),
yesterday AS (SELECT avg({value}) AS y FROM {src} WHERE {day} = DATE '{AS_OF}' - 1 {extra})
SELECT {rd("t")} AS today, {rd("y")} AS yesterday, {rd("t - y")} AS change,
       CASE WHEN t - y < 0 THEN '-' WHEN t - y IS NOT NULL THEN '+' END AS sign
FROM today CROSS JOIN yesterday"""


@register("scalar_cross_join", "2.3", sql=with_views("rv") + ",\n" + _change_sql("score"))
def q_scalar_cross_join(spark, sf_dir):
    return K.kpi_change_cross_join(tables.rv(spark, sf_dir), F.col("score"), AS_OF)


@register("kpi_change", "2.3", sql=with_views("rv") + ",\n" + _change_sql("CASE WHEN sentiment = 'NEGATIVE' THEN 100.0 ELSE 0 END"))
def q_kpi_change(spark, sf_dir):
    """Negative share change in one pass (two conditional averages, no join)."""
    return K.kpi_change(tables.rv(spark, sf_dir), K.neg_flag() * 100.0, AS_OF)


def _dod_sql(value: str, name: str, src: str = "rv", day: str = "CAST(created_time AS DATE)", by: str = "") -> str:
    byc = f"{by}, " if by else ""
    using = f"USING ({by}, dt)" if by else "USING (dt)"
    return f"""d AS (SELECT {byc}{day} AS dt, avg({value}) AS v FROM {src} GROUP BY {byc}{day}),
p AS (SELECT {byc}dt + 1 AS dt, v AS pv FROM d)
SELECT {byc}dt, {rd("v")} AS {name}, {rd("v - pv")} AS change,
       CASE WHEN v - pv < 0 THEN '-' WHEN v - pv IS NOT NULL THEN '+' END AS sign
FROM d LEFT JOIN p {using}"""


@register("day_over_day", "2.5", sql=with_views("rv") + ",\n" + _dod_sql("score", "avg_score"))
def q_day_over_day(spark, sf_dir):
    d = K.daily_values(tables.rv(spark, sf_dir), F.col("score"), "avg_score")
    return K.day_over_day(d, "avg_score")


@register("day_over_day_neg", "2.5", sql=with_views("rv") + ",\n" +
          _dod_sql("CASE WHEN sentiment = 'NEGATIVE' THEN 100.0 ELSE 0 END", "neg_pct"))
def q_day_over_day_neg(spark, sf_dir):
    d = K.daily_values(tables.rv(spark, sf_dir), K.neg_flag() * 100.0, "neg_pct")
    return K.day_over_day(d, "neg_pct")


@register("day_over_day_source", "2.5", sql=with_views("rt") + ",\n" + _dod_sql("score", "avg_score", "rt", "dates", "source"))
def q_day_over_day_source(spark, sf_dir):
    d = tables.rt(spark, sf_dir).groupBy("source", F.col("dates").alias("dt")).agg(F.avg("score").alias("avg_score"))
    return K.day_over_day(d, "avg_score", by=["source"])


# ------------------------------------------------------------------ 2.5 trailing windows

def _win_sql(key: str, a: int, b: int, agg: str) -> str:
    return (f"{agg} OVER (PARTITION BY {key} ORDER BY epoch_us(tx_datetime) "
            f"RANGE BETWEEN {a * DAY_MICROS} PRECEDING AND {b * DAY_MICROS + 1} PRECEDING)")


def _cust_sql() -> str:
    cols = []
    for d in (1, 7, 30):
        cols.append(f"CASE WHEN tx_datetime IS NOT NULL THEN coalesce({_win_sql('customer_id', d, 0, 'count(tx_datetime)')}, 0) END AS c{d}d_cnt")
        cols.append(f"CASE WHEN tx_datetime IS NOT NULL THEN round(coalesce({_win_sql('customer_id', d, 0, 'sum(tx_amount)')}, 0), 6) END AS c{d}d_sum_tx_amount")
    return ", ".join(cols)


_CUST_SQL = with_views("tx_parsed") + f"""
SELECT tranaction_id, customer_id, tx_datetime, {_cust_sql()} FROM tx_parsed"""


def _cust_spark(spark, sf_dir):
    p = parsed(spark, sf_dir)
    out = FE.customer_windows(p)
    cols = ["tranaction_id", "customer_id", "tx_datetime"]
    for d in (1, 7, 30):
        cols += [f"c{d}d_cnt", F.round(f"c{d}d_sum_tx_amount", 6).alias(f"c{d}d_sum_tx_amount")]
    return out.select(*cols)


@register("customer_windows", "2.5", sql=_CUST_SQL)
def q_customer_windows(spark, sf_dir):
    """Per card trailing 1/7/30-day counts and sums on the raw (dirty) transactions, NULL-time rows included."""
    return _cust_spark(spark, sf_dir)


@register("terminal_risk", "2.5", sql=with_views("tx") + f"""
SELECT tranaction_id, terminal_id,
       coalesce({_win_sql('terminal_id', 14, 7, 'count(*)')}, 0) AS t7d_cnt,
       CAST(coalesce({_win_sql('terminal_id', 14, 7, 'sum(tx_fraud)')}, 0) AS BIGINT) AS t7d_sum_tx_fraud,
       round(CASE WHEN coalesce({_win_sql('terminal_id', 14, 7, 'count(*)')}, 0) > 0
             THEN {_win_sql('terminal_id', 14, 7, 'sum(tx_fraud)')} / {_win_sql('terminal_id', 14, 7, 'count(*)')}
             ELSE 0.0 END, 6) AS t7d_risk
FROM tx""")
def q_terminal_risk(spark, sf_dir):
    out = FE.terminal_risk(tables.tx(spark, sf_dir))
    return out.select("tranaction_id", "terminal_id", "t7d_cnt", F.col("t7d_sum_tx_fraud").cast("long").alias("t7d_sum_tx_fraud"),
                      F.round("t7d_risk", 6).alias("t7d_risk"))


@register("impute", "2.5", sql=with_views("tx") + f""",
f AS (SELECT tranaction_id,
             {_win_sql('customer_id', 1, 0, 'sum(tx_amount)')} / NULLIF({_win_sql('customer_id', 1, 0, 'count(*)')}, 0) AS c1d_avg
      FROM tx)
SELECT tranaction_id, round(coalesce(c1d_avg, avg(c1d_avg) OVER ()), 6) AS c1d_avg FROM f""")
def q_impute(spark, sf_dir):
    """Mean amount of a card's last-day transactions; cards without any get the column mean."""
    out = FE.customer_windows(tables.tx(spark, sf_dir), days=(1,))
    out = materialize(out.select("tranaction_id", "c1d_avg"), "window_features")  # read twice: the mean, then the rows
    return FE.impute(out, ["c1d_avg"], "mean").select("tranaction_id", F.round("c1d_avg", 6).alias("c1d_avg"))


# ------------------------------------------------------------------ 2.6 sort, limit, union, dedup

@register("order_by", "2.6", sql=with_views("rv") + """
SELECT CAST(created_time AS DATE) AS dt, count(*) AS n_reviews FROM rv GROUP BY 1 ORDER BY 1""")
def q_order_by(spark, sf_dir):
    r = tables.rv(spark, sf_dir)
    return r.groupBy(F.to_date("created_time").alias("dt")).agg(F.count(F.lit(1)).alias("n_reviews")).orderBy("dt")


@register("union_sources", "2.6", sql=with_views("docs") + """
SELECT id, country, 'store_' || coalesce(country, 'none') AS store, content FROM docs""")
def q_union_sources(spark, sf_dir):
    from ledgerlens.operators.text import union_sources
    d = tables.docs(spark, sf_dir).select("id", "content", "country")
    countries = [r["country"] for r in d.select("country").distinct().collect()]  # one frame per country of the table
    frames = [(d.filter(F.col("country").eqNullSafe(c)).drop("country"), {"country": c, "store": f"store_{c or 'none'}"})
              for c in countries]
    return union_sources(frames).select("id", "country", "store", "content")


@register("dedup_content", "2.6", sql=with_views("docs") + """,
r AS (SELECT *, CAST(substr(source, 4) AS INTEGER) AS source_rank FROM docs),
w AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY source_rank, id) AS rn,
             count(*) OVER (PARTITION BY content) AS n_copies FROM r)
SELECT id, source_rank, country, source, n_copies, content FROM w WHERE rn = 1""")
def q_dedup_content(spark, sf_dir):
    from ledgerlens.operators.text import dedup_content
    d = tables.docs(spark, sf_dir).withColumn("source_rank", F.substring("source", 4, 10).cast("int"))
    out = dedup_content(d)
    return out.select("id", "source_rank", "country", "source", "n_copies", "content")
