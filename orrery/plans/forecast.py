"""Forecast group (rows-only: model fits): next-day close of the priority series
from 10 scaled lags; with a daily sentiment feature on the event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import forecast as fc
from orrery.operators import metrics as mt
from orrery.operators import timeseries as ts
from orrery.plans.common import rnd
from orrery.plans.joins import event_prices
from orrery.plans.series import N_LAGS, scaled_split
from orrery.plans.text import daily_sentiment

KEYS = ["series", "target_date"]


def lagged(spark, sf):
    lf = ts.lag_features(scaled_split(spark, sf), "series", "date", "x", N_LAGS)
    return fc.with_vector(lf)


def _unscale(df):
    """Predictions back on the price scale (min + x (max - min))."""
    return df.withColumn("predicted_close", ts.inverse_scale(F.col("prediction"), F.col("scale_min"), F.col("scale_max")))


def q_forecast_tree(spark, sf):
    lf = lagged(spark, sf)
    train, test = lf.filter(F.col("split") == "train"), lf.filter(F.col("split") == "test")
    _, p, _ = fc.fit_predict(train, test.select(*KEYS, "label", "fv"), fc.regressors()["decision_tree"], KEYS)
    bounds = test.select(*KEYS, "scale_min", "scale_max")
    return _unscale(p.join(bounds, KEYS)).select(*KEYS, "label", "prediction", "predicted_close")


def sentiment_lagged(spark, sf, split_days=5):
    p = event_prices(spark, sf).join(daily_sentiment(spark, sf).select("date", "avg_sentiment"), "date", "left")
    p = ts.time_split(p, "series", "date", split_days)
    p = ts.minmax_scale(p, "series", "close", out="x", fit_mask=F.col("split") == "train")
    lf = ts.lag_features(p, "series", "date", "x", N_LAGS, extra=["avg_sentiment"])
    return fc.with_vector(lf)


def q_forecast_tree_sent(spark, sf):
    lf = sentiment_lagged(spark, sf)
    train, test = lf.filter(F.col("split") == "train"), lf.filter(F.col("split") == "test")
    _, p, _ = fc.fit_predict(train, test, fc.regressors()["decision_tree"], KEYS)
    return p.select(*KEYS, "label", "prediction", F.lit(N_LAGS + 1).alias("n_features"))


def q_forecast_board(spark, sf):
    lf = lagged(spark, sf).cache()
    train, test = lf.filter(F.col("split") == "train"), lf.filter(F.col("split") == "test")
    preds, secs = fc.board(train, test, KEYS)
    m = mt.regression_metrics(preds, "label", "prediction", ["model"])
    t = spark.createDataFrame([(k, f, p) for k, (f, p) in secs.items()],
                              "model string, fit_seconds double, predict_seconds double")
    return m.join(t, "model").select("model", "n", rnd("mae", 6).alias("mae"), rnd("mse", 6).alias("mse"),
                                     rnd("fit_seconds", 3).alias("fit_seconds"),
                                     rnd("predict_seconds", 3).alias("predict_seconds"))


def q_stacked_forecast(spark, sf):
    lf = lagged(spark, sf)
    early = lf.filter((F.col("split") == "train") & (F.col("date") <= F.date_sub("threshold", 60)))
    late = lf.filter((F.col("split") == "train") & (F.col("date") > F.date_sub("threshold", 60)))
    test = lf.filter(F.col("split") == "test")
    p = fc.stacked(early, late, test, KEYS)
    return p.select(*KEYS, "label", "prediction")


QUERIES = {
    "forecast_tree": q_forecast_tree,
    "forecast_tree_sent": q_forecast_tree_sent,
    "forecast_board": q_forecast_board,
    "stacked_forecast": q_stacked_forecast,
}
ORACLE: dict = {}
