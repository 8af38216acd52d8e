"""Next-value forecasters on lag features, their evaluation and stacking
(survey M5-M9, M28, H9, H11).

Feature arrays become ML vectors with the native ``array_to_vector`` (no Python
UDF). Predictions stay keyed by (series, target_date), so they are joined to the
actual values, never zipped by position. Every model is a Spark ML estimator, so
fitting is distributed (trees: per-partition histograms, linear: one Gram pass).
"""

from __future__ import annotations

import time

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_vector(df: DataFrame, arr: str = "features", out: str = "fv") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr)))


def first_of_vector(c: str):
    """vector → its first entry (replaces a row-at-a-time UDF)."""
    return vector_to_array(F.col(c))[0]


def regressors(seed: int = 42) -> dict:
    return {
        "decision_tree": DecisionTreeRegressor(featuresCol="fv", labelCol="label", seed=seed),
        "random_forest": RandomForestRegressor(featuresCol="fv", labelCol="label", numTrees=20, seed=seed),
        "gbt": GBTRegressor(featuresCol="fv", labelCol="label", maxIter=20, seed=seed),
        "linear": LinearRegression(featuresCol="fv", labelCol="label"),
    }


def fit_predict(train: DataFrame, test: DataFrame, est, keys: list[str], pred: str = "prediction"):
    """Fit on ``train``; predictions on ``test`` keyed by ``keys``; fit seconds."""
    t0 = time.time()
    model = est.fit(train)
    secs = time.time() - t0
    p = model.transform(test).select(*keys, "label", F.col("prediction").alias(pred))
    return model, p, secs


def board(train: DataFrame, test: DataFrame, keys: list[str], models: dict | None = None) -> tuple[DataFrame, dict]:
    """Long table (model, keys…, label, prediction) of every model's test
    predictions, and per model (fit seconds, predict seconds) — driver-side wall
    times; predicting is timed as a full pass over the test rows (noop sink)."""
    models = models or regressors()
    out, secs = None, {}
    for name, est in models.items():
        _, p, s = fit_predict(train, test, est, keys)
        t0 = time.time()
        p.write.format("noop").mode("overwrite").save()
        secs[name] = (s, time.time() - t0)
        p = p.withColumn("model", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out, secs


def stacked(train_base: DataFrame, train_meta: DataFrame, test: DataFrame, keys: list[str],
            models: dict | None = None) -> DataFrame:
    """Stacking: base models fit on an earlier period, a linear meta-model fit on
    their predictions over a later period, evaluated on the test period."""
    models = models or regressors()
    fitted = {n: e.fit(train_base) for n, e in models.items()}

    def base_preds(df: DataFrame) -> DataFrame:
        cur = df.select(*keys, "label", "fv")
        for n, m in fitted.items():
            cur = m.setPredictionCol(f"p_{n}").transform(cur)
        return cur.withColumn("meta_fv", array_to_vector(F.array(*[F.col(f"p_{n}") for n in fitted])))

    meta = LinearRegression(featuresCol="meta_fv", labelCol="label").fit(base_preds(train_meta))
    return meta.transform(base_preds(test)).select(*keys, "label", "prediction")
