"""Registered queries for text, vectors, MLlib, evaluation and streaming."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.functions import text as TX
from ledgerlens.functions.datetime import epoch_seconds
from ledgerlens.functions.hashing import POISSON1_CDF
from ledgerlens.operators import evaluation as EV
from ledgerlens.operators import features as FE
from ledgerlens.operators import kpi as K
from ledgerlens.operators import ml as ML
from ledgerlens.operators import text as T
from ledgerlens.operators import vector as V
from ledgerlens.plans.registry import register
from ledgerlens.plans.sqlfixtures import with_views
from ledgerlens.session import materialize, spread
from ledgerlens.sources import files, tables
from ledgerlens.sources.tables import TX_EPOCH
from ledgerlens.streaming import jobs as S

# Fixed query parameters of the registered checks (the search box / widget inputs).
TERM = "ENT"
QUERY = '(the OR le) AND NOT "de la" eau'
SAVED_QUERIES = ("the", "le OR la", "NOT the", '"de la"', "(ent OR oui) AND NOT eau", "des_", "100%", "")
TARGET_ID = 0


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _has(text: str) -> str:
    return f"content ILIKE '%{text}%' ESCAPE '\\'"


# Hand-written SQL for the fixed queries (independent of the query parser): NOT binds tighter
# than AND, AND tighter than OR, adjacent terms mean AND, quotes keep a phrase, % and _ are literal.
QUERY_SQL = f"(({_has('the')} OR {_has('le')}) AND NOT {_has('de la')} AND {_has('eau')})"
SAVED_SQL = {
    "the": _has("the"),
    "le OR la": f"({_has('le')} OR {_has('la')})",
    "NOT the": f"NOT {_has('the')}",
    '"de la"': _has("de la"),
    "(ent OR oui) AND NOT eau": f"(({_has('ent')} OR {_has('oui')}) AND NOT {_has('eau')})",
    "des_": _has("des\\_"),
    "100%": _has("100\\%"),
    "": "TRUE",
}


# ------------------------------------------------------------------ 2.7 text

@register("contains_ci", "2.7", sql=with_views("docs") + f"\nSELECT id FROM docs WHERE {_has(TERM.lower())}")
def q_contains_ci(spark, sf_dir):
    return T.contains(tables.docs(spark, sf_dir), TERM).select("id")


@register("boolean_search", "2.7", sql=with_views("docs") + f"\nSELECT id FROM docs WHERE {QUERY_SQL}")
def q_boolean_search(spark, sf_dir):
    return T.boolean_search(tables.docs(spark, sf_dir), QUERY).select("id")


@register("boolean_search_batch", "2.7", sql=with_views("docs") + "\n" + "\nUNION ALL\n".join(
    f"SELECT {_sql_str(q)} AS query, count(*) FILTER (WHERE {SAVED_SQL[q]}) AS n_rows FROM docs"
    for q in SAVED_QUERIES))
def q_boolean_search_batch(spark, sf_dir):
    return T.boolean_search_batch(tables.docs(spark, sf_dir), SAVED_QUERIES)


@register("top_k", "2.6", sql=with_views("docs") + f"""
SELECT id, content FROM docs WHERE ({_has('the')} OR {_has('le')}) ORDER BY id LIMIT 200""")
def q_top_k(spark, sf_dir):
    """Second page of the comment table for a search (the view grows by 100 rows per page)."""
    hits = T.boolean_search(tables.docs(spark, sf_dir), "the OR le")
    return K.top_k(hits.select("id", "content"), 200)


_NORM_SQL = "regexp_replace(regexp_replace(lower(content), '[^\\p{L}\\p{N}_]', ' ', 'g'), '\\s{2,}', ' ', 'g')"
_STOP_SQL = "[" + ", ".join(_sql_str(w) for w in TX.STOPWORDS) + "]"


@register("normalize_text", "2.7", sql=with_views("docs") + f"\nSELECT id, {_NORM_SQL} AS norm_text FROM docs")
def q_normalize_text(spark, sf_dir):
    return T.normalize(tables.docs(spark, sf_dir)).select("id", "norm_text")


@register("remove_stopwords", "2.7", sql=with_views("docs") + f"""
SELECT id, array_to_string(list_filter(string_split({_NORM_SQL}, ' '), lambda w: w <> '' AND NOT list_contains({_STOP_SQL}, w)), ' ') AS clean_text
FROM docs""")
def q_remove_stopwords(spark, sf_dir):
    return T.strip_stopwords(T.normalize(tables.docs(spark, sf_dir))).select("id", "clean_text")


_WORDS_SQL = (f"list_filter(string_split({_NORM_SQL}, ' '), lambda w: w <> '' AND NOT list_contains({_STOP_SQL}, w))")


@register("embed_text", "2.7", sql=with_views("docs") + f""",
t AS (SELECT id, content, {_WORDS_SQL} AS words FROM docs),
known AS (SELECT w FROM (SELECT unnest(words) AS w FROM t) GROUP BY w HAVING count(*) >= 5),
hit AS (SELECT DISTINCT id FROM (SELECT id, unnest(words) AS w FROM t) JOIN known USING (w))
SELECT t.id, content, 100 AS dims, hit.id IS NULL AS is_zero, TRUE AS same_as_equal_text
FROM t LEFT JOIN hit USING (id)""")
def q_embed_text(spark, sf_dir):
    """Skip-gram vectors (100 dims) trained on the review corpus, one mean vector per review, by what is certain
    of them: equal texts have equal vectors, and only a text without a known word has the zero vector."""
    out, _ = T.embed_text(tables.docs(spark, sf_dir))
    out = materialize(out.select("id", "content", "embeddings"), "embedded")
    digest = F.sha2(F.coalesce("content", F.lit("")), 256)
    vec = F.xxhash64("embeddings")
    spread = out.groupBy(digest.alias("_sha")).agg((F.min(vec) == F.max(vec)).alias("same_as_equal_text"))
    return (out.withColumn("_sha", digest).join(spread, "_sha")
               .select("id", "content", F.size("embeddings").alias("dims"),
                       F.forall("embeddings", lambda v: v == 0).alias("is_zero"), "same_as_equal_text"))


_DIST_SQL = ("sqrt(list_sum(list_transform(list_zip(e.embeddings, t.embeddings), "
             "lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))))")


@register("scalar_subquery", "2.3", sql=with_views("emb") + f"""
SELECT e.id, round({_DIST_SQL}, 6) AS distance FROM emb e, (SELECT embeddings FROM emb WHERE id = {TARGET_ID}) t""")
def q_scalar_subquery(spark, sf_dir):
    d = V.scalar_subquery(tables.emb(spark, sf_dir), TARGET_ID)
    return d.select("id", F.round("distance", 6).alias("distance"))


@register("similar_rows", "2.7", sql=with_views("emb") + f""",
d AS (SELECT e.id, {_DIST_SQL} AS dist FROM emb e, (SELECT embeddings FROM emb WHERE id = {TARGET_ID}) t)
SELECT id, round(dist, 6) AS distance FROM d ORDER BY dist, id LIMIT 100""")
def q_similar_rows(spark, sf_dir):
    s = V.similar_rows(tables.emb(spark, sf_dir), TARGET_ID, k=100)
    return s.select("id", F.round("distance", 6).alias("distance"))


@register("similar_rows_batch", "2.7", sql=with_views("emb") + f""",
q AS (SELECT id AS query_id, embeddings FROM emb WHERE label = 0),
d AS (SELECT q.query_id, e.id, {_DIST_SQL.replace('t.embeddings', 'q.embeddings')} AS dist FROM q, emb e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS rank FROM d)
SELECT query_id, id, round(dist, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def q_similar_rows_batch(spark, sf_dir):
    """10 nearest rows for every row of label 0, in one pass over the table."""
    e = tables.emb(spark, sf_dir)
    qs = e.filter(F.col("label") == 0).select(F.col("id").alias("query_id"), "embeddings")
    out = V.similar_rows_batch(e, qs, k=10)
    return out.select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


# ------------------------------------------------------------------ 2.8 MLlib

def _days_x(ts="tx_datetime"):
    return ((epoch_seconds(ts) - F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', TIMESTAMP_NTZ'{TX_EPOCH}')"))
            / 86400.0)


def _parsed(spark, sf_dir):
    return files.parse_transaction_lines(tables.tx_lines(spark, sf_dir))


@register("assemble_features", "2.8", sql=with_views("tx_parsed") + """
SELECT tranaction_id, tx_amount AS f1, tx_time_seconds AS f2, CAST(tx_time_days AS DOUBLE) AS f3 FROM tx_parsed
WHERE tx_amount IS NOT NULL AND tx_time_seconds IS NOT NULL AND tx_time_days IS NOT NULL""")
def q_assemble_features(spark, sf_dir):
    """Rows with a missing input are skipped (``handleInvalid='skip'``); the vector shown as f1..f3."""
    d = ML.assemble_features(_parsed(spark, sf_dir), ["tx_amount", "tx_time_seconds", "tx_time_days"])
    v = vector_to_array("features")
    return d.select("tranaction_id", *[F.get(v, i).alias(f"f{i + 1}") for i in range(3)])


@register("linear_fit", "2.8", sql=with_views("tx_parsed") + f""",
x AS (SELECT (epoch_us(tx_datetime) // 1000000 - epoch_us(TIMESTAMP '{TX_EPOCH}') // 1000000) / 86400.0 AS x, tx_time_seconds AS y FROM tx_parsed)
SELECT round(regr_intercept(y, x), 4) AS intercept, round(regr_slope(y, x), 4) AS coef_x FROM x""")
def q_linear_fit(spark, sf_dir):
    """OLS of the seconds counter on elapsed days (MLlib ``LinearRegression``, normal equations)."""
    d = _parsed(spark, sf_dir).withColumn("x", _days_x())
    model = ML.linear_fit(d, ["x"], "tx_time_seconds")
    c = ML.linear_coefficients(model, ["x"])
    return c.select(F.round("intercept", 4).alias("intercept"), F.round("coef_x", 4).alias("coef_x"))


@register("linear_predict", "2.8", sql=with_views("tx_parsed") + f""",
x AS (SELECT tranaction_id, (epoch_us(tx_datetime) // 1000000 - epoch_us(TIMESTAMP '{TX_EPOCH}') // 1000000) / 86400.0 AS x,
             tx_time_seconds AS y FROM tx_parsed),
c AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM x)
SELECT tranaction_id, round(a + b * x, 0) AS prediction FROM x, c WHERE x IS NOT NULL""")
def q_linear_predict(spark, sf_dir):
    """Every row with a feature scored by the fitted OLS line; predicted seconds in whole seconds."""
    d = _parsed(spark, sf_dir).withColumn("x", _days_x())
    model = ML.linear_fit(d, ["x"], "tx_time_seconds")
    pred = ML.linear_predict(model, ML.assemble_features(d, ["x"]))
    return pred.select("tranaction_id", F.round("prediction", 0).alias("prediction"))


def _labelled(spark, sf_dir):
    """Reviews with a class: toxic 2 (NEGATIVE), else good quality 1 (POSITIVE), else 0 (NEUTRAL)."""
    lab = tables.load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, 2.0).when(F.col("quality") == 1, 1.0).otherwise(0.0).alias("label"))
    return EV.train_test_split(tables.docs(spark, sf_dir).join(lab, "id"), "id")


def sentiment_model(spark, sf_dir):
    """The sentiment model of the labelled training reviews, which are staged in even parts: a fit passes over them many times.

    Every part of a pass sends a gradient as large as the model (three classes of 262,144 terms), so there is a part a core, not
    one for every few MB of text.
    """
    train = _labelled(spark, sf_dir).filter(F.col("split") == "train").select("content", "label")
    return ML.sentiment_pipeline().fit(materialize(spread(train), "sentiment_train").coalesce(spark.sparkContext.defaultParallelism))


@register("score_sentiment", "2.8")
def q_score_sentiment(spark, sf_dir):
    """TF-IDF + logistic regression trained on labelled reviews, scoring every review, ids mapped to names."""
    from ledgerlens.operators.cleaning import map_labels
    model = sentiment_model(spark, sf_dir)
    docs = spread(tables.docs(spark, sf_dir).select("id", "content"))
    return map_labels(ML.score_sentiment(model, docs), "sentiment_id").select("id", "sentiment_id", "sentiment")


@register("sentiment_holdout", "2.8", sql="""
WITH l AS (SELECT d.doc_id, CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 1 ELSE 0 END AS label
           FROM documents d JOIN labels USING (doc_id)),
t AS (SELECT label FROM l WHERE (CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0) < 0.2)
SELECT CAST(label AS INTEGER) AS label, count(*) AS n_held_out, TRUE AS chance_or_better FROM t GROUP BY label""")
def q_sentiment_holdout(spark, sf_dir):
    """Labelled reviews the sentiment model was not trained on, per class, and whether its predictions of all of them
    agree with the labels at least as often as chance would (Cohen's kappa not negative)."""
    return _sentiment_recall(spark, sf_dir).groupBy("label").agg(
        F.first("n_held_out").alias("n_held_out"), F.first("chance_or_better").alias("chance_or_better"))


@register("sentiment_recall", "2.8")
def q_sentiment_recall(spark, sf_dir):
    """Held-out reviews and correct predictions per class."""
    return _sentiment_recall(spark, sf_dir).select("label", "n_held_out", "n_right")


def _sentiment_recall(spark, sf_dir):
    d = _labelled(spark, sf_dir)
    model = ML.sentiment_pipeline().fit(d.filter(F.col("split") == "train"))
    pred = materialize(ML.score_sentiment(model, d.filter(F.col("split") == "test")).select(
        F.col("label").cast("int").alias("label"), "sentiment_id"), "held_out")
    said = pred.groupBy(F.col("sentiment_id").alias("label")).agg(F.count(F.lit(1)).alias("_said"))  # one row per class
    per = pred.groupBy("label").agg(F.count(F.lit(1)).alias("n_held_out"),
                                    F.count_if(F.col("label") == F.col("sentiment_id")).alias("n_right"))
    per = per.join(F.broadcast(said), "label", "left")
    total = per.agg((F.sum("n_right") * F.sum("n_held_out") >= F.sum(F.col("n_held_out") * F.coalesce("_said", F.lit(0))))
                    .alias("chance_or_better"))  # one row
    return per.crossJoin(F.broadcast(total))


def _fraud_features(spark, sf_dir):
    """Window features, computed once and written: fit and scoring pass over them many times."""
    t = tables.tx(spark, sf_dir)
    f = FE.customer_windows(t, days=(1, 7))
    f = FE.terminal_risk(f)
    return EV.time_split(materialize(FE.impute(f, ["c1d_avg", "c7d_avg"], "zero"), "fraud_features"))


def _upsampled(train):
    return EV.upsample(train, EV.class_balance(train))


FRAUD_FEATURES = ["tx_amount", "c1d_cnt", "c1d_avg", "c7d_cnt", "c7d_avg", "t7d_cnt", "t7d_risk"]


@register("train_fraud", "2.8")
def q_train_fraud(spark, sf_dir):
    """Random forest on card and terminal window features, trained on the older days with the rare class
    upsampled; predictions for the newest days."""
    f = _fraud_features(spark, sf_dir)
    model = ML.train_fraud(_upsampled(f.filter(F.col("split") == "train")), FRAUD_FEATURES, kind="rf")
    return model.transform(f.filter(F.col("split") == "test")).select("tranaction_id", "tx_fraud", "prediction")


_TIME_SPLIT_SQL = """
d AS (SELECT tx_time_days AS day, count(*) AS n FROM tx WHERE tx_time_days IS NOT NULL GROUP BY 1),
cum AS (SELECT day, sum(n) OVER (ORDER BY day DESC) AS cum, sum(n) OVER () AS total FROM d),
first_day AS (SELECT max(day) AS day FROM cum WHERE cum >= total * 0.2),
s AS (SELECT tx.*, CASE WHEN tx_time_days >= first_day.day THEN 'test' ELSE 'train' END AS split FROM tx, first_day)"""


@register("time_split", "2.8", sql=with_views("tx") + "," + _TIME_SPLIT_SQL + """
SELECT split, tx_fraud, count(*) AS n, min(tx_time_days) AS first_day, max(tx_time_days) AS last_day FROM s GROUP BY 1, 2""")
def q_time_split(spark, sf_dir):
    """Training and hold-out days of the fraud model."""
    return EV.time_split(tables.tx(spark, sf_dir)).groupBy("split", "tx_fraud").agg(
        F.count(F.lit(1)).alias("n"), F.min("tx_time_days").alias("first_day"), F.max("tx_time_days").alias("last_day"))


@register("fraud_model_report", "2.8", sql=with_views("tx") + "," + _TIME_SPLIT_SQL + """
SELECT count(*) AS n_scored, count(*) FILTER (WHERE tx_fraud = 1) AS n_fraud, TRUE AS interval_holds_fnr, TRUE AS interval_holds_fpr
FROM s WHERE split = 'test'""")
def q_fraud_model_report(spark, sf_dir):
    """The second model version end to end, by what is certain of it: every hold-out row is in one confusion cell,
    and the bootstrap intervals hold the measured rates."""
    r = _fraud_report(spark, sf_dir)
    return r.select((F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).cast("long").alias("n_scored"),
                    (F.col("tp") + F.col("fn")).cast("long").alias("n_fraud"),
                    F.col("fnr").between(F.col("fnr_lo"), F.col("fnr_hi")).alias("interval_holds_fnr"),
                    F.col("fpr").between(F.col("fpr_lo"), F.col("fpr_hi")).alias("interval_holds_fpr"))


def _fraud_report(spark, sf_dir):
    """Window features -> split by time -> upsampled logistic regression -> FNR/FPR on the newest days with their
    targets, and a bootstrap interval for both."""
    f = _fraud_features(spark, sf_dir)
    model = ML.train_fraud(_upsampled(f.filter(F.col("split") == "train")), FRAUD_FEATURES, kind="lr")
    pred = (model.transform(f.filter(F.col("split") == "test"))
                 .withColumn("prediction", F.col("prediction").cast("int")))
    pred = materialize(pred.select("tranaction_id", "tx_fraud", "prediction"), "fraud_predictions")
    return EV.fraud_metrics(pred).crossJoin(F.broadcast(EV.bootstrap_ci(pred, "tranaction_id", replicates=100)))


@register("fraud_model_rates", "2.8")
def q_fraud_model_rates(spark, sf_dir):
    """The rates themselves: confusion cells, FNR, FPR, targets and intervals of the second model version."""
    return _fraud_report(spark, sf_dir)


# ------------------------------------------------------------------ 2.8 evaluation

_RULE = "CAST(tx_amount >= 100 AS INTEGER)"


def _ruled(spark, sf_dir):
    return tables.tx(spark, sf_dir).withColumn("prediction", (F.col("tx_amount") >= 100).cast("int"))


_CELLS_SQL = """sum(CASE WHEN tx_fraud = 1 AND prediction = 1 THEN {w} ELSE 0 END) AS tp,
       sum(CASE WHEN tx_fraud = 0 AND prediction = 1 THEN {w} ELSE 0 END) AS fp,
       sum(CASE WHEN tx_fraud = 0 AND prediction = 0 THEN {w} ELSE 0 END) AS tn,
       sum(CASE WHEN tx_fraud = 1 AND prediction = 0 THEN {w} ELSE 0 END) AS fn"""


@register("fraud_metrics", "2.8", sql=with_views("tx") + f""",
p AS (SELECT *, {_RULE} AS prediction FROM tx),
c AS (SELECT {_CELLS_SQL.format(w=1)} FROM p)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
       round(fn / (fn + tp), 6) AS fnr, round(fp / (fp + tn), 6) AS fpr,
       fn / (fn + tp) < 0.02 AS fnr_ok, fp / (fp + tn) < 0.05 AS fpr_ok FROM c""")
def q_fraud_metrics(spark, sf_dir):
    m = EV.fraud_metrics(_ruled(spark, sf_dir))
    return m.withColumns({"fnr": F.round("fnr", 6), "fpr": F.round("fpr", 6)})


@register("monthly_damage", "2.8", sql=with_views("tx") + f"""
SELECT CAST(date_trunc('month', CAST(tx_datetime AS DATE)) AS DATE) AS month,
       coalesce(sum(tx_amount) FILTER (WHERE tx_fraud = 1 AND {_RULE} = 0), 0.0) AS damage, count(*) FILTER (WHERE tx_fraud = 1 AND {_RULE} = 0) AS n_missed,
       coalesce(sum(tx_amount) FILTER (WHERE tx_fraud = 1 AND {_RULE} = 0), 0.0) <= 500000 AS within_limit
FROM tx WHERE tx_datetime IS NOT NULL GROUP BY 1""")
def q_monthly_damage(spark, sf_dir):
    d = EV.monthly_damage(_ruled(spark, sf_dir))
    return d.withColumn("damage", F.round("damage", 6))


def _poisson_sql(u: str) -> str:
    return " + ".join(f"CAST({u} >= {p!r} AS INTEGER)" for p in POISSON1_CDF)


_U_SQL = "(CAST(('0x' || substr(md5(CAST(tranaction_id AS VARCHAR) || '|' || CAST(blk AS VARCHAR)), CAST(1 + 8 * j AS INTEGER), 8)) AS BIGINT) / 4294967296.0)"
REPLICATES = 50


@register("bootstrap_ci", "2.8", sql=with_views("tx") + f""",
p AS (SELECT *, {_RULE} AS prediction FROM tx),
w AS (SELECT tx_fraud, prediction, {_poisson_sql(_U_SQL)} AS w, blk * 4 + j AS rep FROM p, range(0, {(REPLICATES + 3) // 4}) b(blk), range(0, 4) r(j)
      WHERE blk * 4 + j < {REPLICATES}),
c AS (SELECT rep, {_CELLS_SQL.format(w='w')} FROM w GROUP BY rep),
r AS (SELECT fn / CASE WHEN fn + tp > 0 THEN fn + tp END AS fnr, fp / CASE WHEN fp + tn > 0 THEN fp + tn END AS fpr FROM c)
SELECT round(quantile_cont(fnr, 0.025), 6) AS fnr_lo, round(quantile_cont(fnr, 0.975), 6) AS fnr_hi,
       round(quantile_cont(fpr, 0.025), 6) AS fpr_lo, round(quantile_cont(fpr, 0.975), 6) AS fpr_hi FROM r""")
def q_bootstrap_ci(spark, sf_dir):
    b = EV.bootstrap_ci(_ruled(spark, sf_dir), "tranaction_id", replicates=REPLICATES)
    return b.select(*[F.round(c, 6).alias(c) for c in b.columns])


def _unit_sql(at: int) -> str:
    return f"((CAST(('0x' || substr(h, {at}, 8)) AS BIGINT) + 0.5) / 4294967296.0)"


@register("bootstrap_ci_cells", "2.8", sql=with_views("tx") + f""",
n AS (SELECT y, p, CAST(count(*) AS DOUBLE) AS n FROM (SELECT tx_fraud AS y, {_RULE} AS p FROM tx) WHERE y IN (0, 1) AND p IN (0, 1) GROUP BY y, p),
d AS (SELECT *, md5('1|' || rep || '|' || y || '|' || p) AS h FROM n, range(0, {REPLICATES}) r(rep)),
f AS (SELECT y, p, sum(exp(k * ln(n) - n - lgamma(k + 1))) OVER (PARTITION BY y, p ORDER BY k) AS c FROM n, range(0, 241) t(k) WHERE n <= 60),
w AS (SELECT rep, y AS tx_fraud, p AS prediction,
             CASE WHEN n <= 60 THEN (SELECT count(*) FROM f WHERE f.y = d.y AND f.p = d.p AND {_unit_sql(1)} >= f.c)
                  ELSE greatest(round(n + sqrt(n) * sqrt(-2 * ln({_unit_sql(9)})) * cos(2 * pi() * {_unit_sql(17)})), 0) END AS w FROM d),
c AS (SELECT rep, {_CELLS_SQL.format(w='w')} FROM w GROUP BY rep),
r AS (SELECT fn / CASE WHEN fn + tp > 0 THEN fn + tp END AS fnr, fp / CASE WHEN fp + tn > 0 THEN fp + tn END AS fpr FROM c)
SELECT round(quantile_cont(fnr, 0.025), 6) AS fnr_lo, round(quantile_cont(fnr, 0.975), 6) AS fnr_hi,
       round(quantile_cont(fpr, 0.025), 6) AS fpr_lo, round(quantile_cont(fpr, 0.975), 6) AS fpr_hi FROM r""")
def q_bootstrap_ci_cells(spark, sf_dir):
    """The bootstrap interval from one draw per confusion cell and replicate."""
    b = EV.bootstrap_ci_cells(_ruled(spark, sf_dir), replicates=REPLICATES)
    return b.select(*[F.round(c, 6).alias(c) for c in b.columns])


@register("best_run", "2.8", sql=with_views("tx") + f""",
runs AS (SELECT CAST(tx_datetime AS DATE) AS started,
                round(sum(CASE WHEN tx_fraud = 1 AND {_RULE} = 1 THEN 1 ELSE 0 END) / sum(tx_fraud), 6) AS metric
         FROM tx GROUP BY 1)
SELECT started, metric, CASE WHEN row_number() OVER (ORDER BY metric DESC NULLS LAST, started) = 1 THEN 1 ELSE 0 END AS best_model
FROM runs""")
def q_best_run(spark, sf_dir):
    """One training run per day (its recall on that day's data); exactly one holds ``best_model = 1``."""
    t = _ruled(spark, sf_dir)
    runs = t.groupBy(F.to_date("tx_datetime").alias("started")).agg(
        F.round(F.sum(F.when((F.col("tx_fraud") == 1) & (F.col("prediction") == 1), 1).otherwise(0)) / F.sum("tx_fraud"), 6)
        .alias("metric"))
    return EV.best_run(runs)


@register("class_balance", "2.8", sql=with_views("tx") + """,
c AS (SELECT tx_fraud, count(*) AS n FROM tx GROUP BY tx_fraud),
m AS (SELECT max(n) AS mx FROM c)
SELECT tx_fraud, n, round(mx / n, 6) AS ratio, CAST(round(mx / n) AS INTEGER) AS factor,
       n * CAST(round(mx / n) AS INTEGER) AS n_upsampled FROM c, m""")
def q_class_balance(spark, sf_dir):
    b = EV.class_balance(tables.tx(spark, sf_dir))
    return b.withColumn("ratio", F.round("ratio", 6))


@register("upsample", "2.8", sql=with_views("tx") + """,
c AS (SELECT tx_fraud, count(*) AS n FROM tx GROUP BY tx_fraud),
m AS (SELECT max(n) AS mx, min(n) AS mn FROM c),
f AS (SELECT tx_fraud, CASE WHEN n = mx THEN 1 ELSE CAST(round(mx / mn) AS INTEGER) END AS factor FROM c, m)
SELECT tx_fraud, count(*) AS n_rows, count(DISTINCT tranaction_id) AS n_distinct
FROM tx JOIN f USING (tx_fraud), range(1, 1000) r(i) WHERE i <= factor GROUP BY tx_fraud""")
def q_upsample(spark, sf_dir):
    t = tables.tx(spark, sf_dir)
    up = EV.upsample(t, EV.class_balance(t))
    return up.groupBy("tx_fraud").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("tranaction_id").alias("n_distinct"))


@register("train_test_split", "2.8", sql=with_views("tx") + """
SELECT CASE WHEN (CAST(('0x' || substr(md5(CAST(tranaction_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0) < 0.2
            THEN 'test' ELSE 'train' END AS split, tx_fraud, count(*) AS n
FROM tx GROUP BY 1, 2""")
def q_train_test_split(spark, sf_dir):
    s = EV.train_test_split(tables.tx(spark, sf_dir), "tranaction_id")
    return s.groupBy("split", "tx_fraud").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ 2.1 / 2.9 streaming

_STREAM_SQL = """
SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS y, value AS X1,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS X2, CAST(hour(ts) AS DOUBLE) AS X3 FROM events"""


@register("stream_source", "2.1", sql="""
SELECT event_id, CAST(event_id % 2 AS VARCHAR) AS key,
       CAST(to_json({'X': [value, CAST(json_extract_string(props, '$.k') AS DOUBLE), CAST(hour(ts) AS DOUBLE)], 'y': value}) AS VARCHAR) AS value
FROM events""")
def q_stream_source(spark, sf_dir):
    """Raw train messages (key, JSON value) landed from the stream source."""
    landed = spark.read.parquet(S.land_stream(spark, S.stream_source(spark, sf_dir), "raw"))
    return landed.select("event_id", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@register("stream_sink_append", "2.1", sql=_STREAM_SQL)
def q_stream_sink_append(spark, sf_dir):
    """Parsed stream rows appended per micro-batch (idempotent by batch id) and read back."""
    return S.stream_sink_append(spark, sf_dir).select("event_id", F.col("y").cast("double").alias("y"), "X1", "X2", "X3")


@register("stream_features", "2.9", sql="""
SELECT event_id, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 2) AS y, value AS f1,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS f2, CAST(hour(ts) AS DOUBLE) AS f3 FROM events""")
def q_stream_features(spark, sf_dir):
    """Stream rows -> feature vectors (shown as f1..f3), landed and read back."""
    feats = S.stream_features(S.stream_source(spark, sf_dir))
    v = vector_to_array("features")
    flat = feats.select("event_id", F.round(F.col("y").cast("double"), 2).alias("y"),
                        *[F.get(v, i).alias(f"f{i + 1}") for i in range(3)])
    return spark.read.parquet(S.land_stream(spark, flat, "features")).drop("batch_id")


@register("stream_sink_json", "2.1", sql="""
SELECT round(CAST(CAST(value AS FLOAT) AS DOUBLE), 2) AS y, value AS prediction FROM events""")
def q_stream_sink_json(spark, sf_dir):
    """``{"y", "prediction"}`` JSON messages written by a streaming sink, read back and parsed
    (y is a float in the message; amounts have cents, so 2 places recover it exactly)."""
    feats = S.stream_features(S.stream_source(spark, sf_dir)).withColumn("prediction", F.col("X1").cast("double"))
    out = S.json_sink(spark, feats, "json_sink")
    p = spark.read.text(out).select(F.from_json("value", "y double, prediction double").alias("p"))
    return p.select(F.round("p.y", 2).alias("y"), F.col("p.prediction").alias("prediction"))


@register("stream_train_then_score", "2.9", sql="""
SELECT round(CAST(CAST(value + CAST(json_extract_string(props, '$.k') AS DOUBLE) + hour(ts) AS FLOAT) AS DOUBLE), 2) AS y,
       round(value + CAST(json_extract_string(props, '$.k') AS DOUBLE) + hour(ts), 2) AS prediction FROM events
WHERE (CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0) < 0.2""")
def q_stream_train_then_score(spark, sf_dir):
    """Land the stream, fit OLS on the training part, score the held-out part, emit JSON, read it back.

    The messages hold the sum of three numbers and the numbers scaled by 2, 3 and 1: a right fit undoes the
    scales, so the held-out predictions, in cents, equal the sums.
    """
    _, out = S.stream_train_then_score(spark, sf_dir)
    p = spark.read.text(out).select(F.from_json("value", "y double, prediction double").alias("p"))
    return p.select(F.round("p.y", 2).alias("y"), F.round("p.prediction", 2).alias("prediction"))


@register("stream_daily_kpi", "2.9", sql="""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS dt, avg(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS avg_score,
                  avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS neg_share, count(*) AS n_reviews
           FROM orders GROUP BY 1)
SELECT dt, round(avg_score, 6) AS avg_score, round(neg_share, 6) AS neg_share, n_reviews FROM d""")
def q_stream_daily_kpi(spark, sf_dir):
    """Every day of the stream, from mergeable per-batch sums."""
    d = S.stream_daily_kpi(spark, sf_dir)
    return d.select("dt", F.round("avg_score", 6).alias("avg_score"), F.round("neg_share", 6).alias("neg_share"), "n_reviews")
