"""MLlib operators on DataFrames.

Fitting runs on the cluster through MLlib estimators; only model coefficients reach the
driver.  The original trained on ``limit(10000)`` rows in no defined order; these fit
on the rows they are given (pass a hash sample from ``sources.files.sample_rows`` for a
cheaper, still reproducible fit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import text as T


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """Columns -> one dense vector; rows with a NULL input are skipped (the default would fail the job)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def linear_fit(df: DataFrame, features: Sequence[str], label: str, features_col: str = "features"):
    """Ordinary least squares (normal equations, no regularisation)."""
    data = df if features_col in df.columns else assemble_features(df, features, features_col)
    lr = LinearRegression(featuresCol=features_col, labelCol=label, solver="normal", regParam=0.0)
    return lr.fit(data.filter(F.col(label).isNotNull()))


def linear_coefficients(model, names: Sequence[str]) -> DataFrame:
    """A fitted linear model as a one-row DataFrame (``intercept``, one column per coefficient)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    row = {"intercept": float(model.intercept)}
    row.update({f"coef_{n}": float(c) for n, c in zip(names, model.coefficients.toArray())})
    return spark.createDataFrame([row])


def linear_predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def sentiment_pipeline(text_col: str = "content", label_col: str = "label", num_features: int = 1 << 18) -> Pipeline:
    """Normalised tokens -> hashed term frequencies -> IDF -> multinomial logistic regression."""
    def lit(pattern: str) -> str:  # a regex as a SQL string literal: backslashes are escapes there
        return "'" + pattern.replace("\\", "\\\\") + "'"

    tok = SQLTransformer(statement=(
        f"SELECT *, filter(split(lower({text_col}), {lit(T.NON_WORD + '+')}), w -> w != '') AS _tokens FROM __THIS__"))
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_tfidf")
    lr = LogisticRegression(featuresCol="_tfidf", labelCol=label_col, family="multinomial", maxIter=50, regParam=0.01)
    return Pipeline(stages=[tok, tf, idf, lr])


def score_sentiment(model: PipelineModel, df: DataFrame, out: str = "sentiment_id") -> DataFrame:
    pred = model.transform(df)
    return pred.withColumn(out, F.col("prediction").cast("int")).drop("_tokens", "_tf", "_tfidf", "rawPrediction",
                                                                    "probability", "prediction")


def train_fraud(train: DataFrame, features: Sequence[str], label: str = "tx_fraud", kind: str = "rf",
                seed: int = 42) -> PipelineModel:
    """Fraud classifier: random forest (first version) or logistic regression (second)."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    if kind == "rf":
        clf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=20, maxDepth=6, seed=seed)
    elif kind == "lr":
        clf = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50)
    else:
        raise ValueError("kind must be 'rf' or 'lr'")
    return Pipeline(stages=[asm, clf]).fit(train.withColumn(label, F.col(label).cast("double")))
