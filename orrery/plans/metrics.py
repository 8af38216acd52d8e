"""Metric group: binary scores from labels ⋈ documents, multiclass scores from
embeddings (nearest centroid over the whole vector), forecast errors from series."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import classify as cl
from orrery.operators import metrics as mt
from orrery.operators import timeseries as ts
from orrery.plans.common import rnd
from orrery.plans.joins import event_prices
from orrery.plans.series import prices
from orrery.sources.tables import Tables

N_CLS = 10
CLASSES = list(range(N_CLS))


def binary_scores(spark, sf):
    t = Tables(spark, sf)
    j = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return j.select("doc_id", F.col("quality").alias("y"),
                    F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0)), 2).alias("score"))


def multiclass_scores(spark, sf):
    e = Tables(spark, sf).embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    return cl.centroid_scores(e, "label", "embedding", CLASSES).drop("embedding")


def q_confusion_matrix(spark, sf):
    m = multiclass_scores(spark, sf)
    cm = mt.confusion_matrix(m, "label", "pred", CLASSES)
    return cm.select("label", *[F.col(str(c)).alias(f"pred_{c}") for c in CLASSES])


def q_clf_metrics(spark, sf):
    m = multiclass_scores(spark, sf)
    s = mt.classification_summary(m, "label", "pred", {c: f"p{c}" for c in CLASSES})
    return s.select("n", rnd("accuracy", 6).alias("accuracy"), rnd("macro_f1", 6).alias("macro_f1"),
                    rnd("weighted_auc", 6).alias("weighted_auc"))


def q_roc_points(spark, sf):
    p = mt.roc_points(binary_scores(spark, sf), "y", "score")
    return p.select("threshold", "pos", "neg", rnd("tpr", 6).alias("tpr"), rnd("fpr", 6).alias("fpr"))


def q_roc_auc(spark, sf):
    p = mt.roc_points(binary_scores(spark, sf), "y", "score")
    return mt.roc_auc(p).select(rnd("auc", 6).alias("auc"))


def q_roc_auc_per_class(spark, sf):
    """One-vs-rest ROC AUC per class of the multiclass scores."""
    m = multiclass_scores(spark, sf)
    a = mt.ovr_auc(m, "label", {c: f"p{c}" for c in CLASSES})
    return a.select(F.col("cls").cast("int").alias("cls"), rnd("auc", 6).alias("auc"), "support")


def q_regression_metrics(spark, sf):
    p = event_prices(spark, sf)
    lf = ts.lag_features(p, "series", "date", "close", 10)
    pr = lf.select("series", (F.aggregate("features", F.lit(0.0), lambda a, b: a + b) / 10).alias("pred"), "label")
    r = mt.regression_metrics(pr, "label", "pred", ["series"])
    return r.select("series", "n", rnd("mae", 6).alias("mae"), rnd("mse", 6).alias("mse"),
                    rnd("rmse", 6).alias("rmse"))


def baseline_errors(spark, sf):
    """Next-day forecasts of three baseline models on the priority series."""
    lf = ts.lag_features(prices(spark, sf), "series", "date", "close", 10)
    f = F.col("features")
    preds = {"last_value": f[9], "mean_3": (f[7] + f[8] + f[9]) / 3,
             "mean_10": F.aggregate(f, F.lit(0.0), lambda a, b: a + b) / 10}
    long = lf.select("series", "label", F.explode(F.array(*[
        F.struct(F.lit(k).alias("model"), v.alias("pred")) for k, v in preds.items()])).alias("m"))
    long = long.select("series", "label", "m.model", "m.pred")
    return mt.regression_metrics(long, "label", "pred", ["series", "model"])


def q_leaderboard(spark, sf):
    e = baseline_errors(spark, sf).select("series", "model", rnd("mae", 4).alias("mae"),
                                           rnd("rmse", 4).alias("rmse"))
    return mt.leaderboard(e, ["mae", "series", "model"], 10)


def q_accuracy(spark, sf):
    m = multiclass_scores(spark, sf)
    a = mt.accuracy(m, "label", "pred")
    return a.select(rnd("accuracy", 6).alias("accuracy"), rnd("error_rate", 6).alias("error_rate"), "n")


QUERIES = {
    "confusion_matrix": q_confusion_matrix,
    "clf_metrics": q_clf_metrics,
    "roc_points": q_roc_points,
    "roc_auc": q_roc_auc,
    "roc_auc_per_class": q_roc_auc_per_class,
    "regression_metrics": q_regression_metrics,
    "leaderboard": q_leaderboard,
    "accuracy": q_accuracy,
}

BIN_SQL = """b AS (SELECT l.doc_id, l.quality AS y, round(d.n_chars / (d.n_chars + 2000.0), 2) AS score
  FROM labels l JOIN documents d USING (doc_id)),
c AS (SELECT score AS threshold, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM b GROUP BY score),
r AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS cum_pos, sum(neg) OVER (ORDER BY threshold DESC) AS cum_neg,
        sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)"""
_DIST = ", ".join(f"max(d) FILTER (WHERE cls = {c}) AS d{c}" for c in CLASSES)
_EXP = ", ".join(f"coalesce(exp(least - d{c}), 0) AS e{c}" for c in CLASSES)
_PRED = " ".join(f"WHEN round(d{c}, 9) = round(least, 9) THEN {c}" for c in CLASSES)
_TOT = " + ".join(f"e{c}" for c in CLASSES)
MC_SQL = f"""cv AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding) AS x FROM embeddings),
cm AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM cv GROUP BY 1, 2),
cc AS (SELECT label AS cls, list(m ORDER BY pos) AS v FROM cm GROUP BY 1),
dd AS (SELECT vec_id, label, cls, list_sum(list_transform(range(1, len(v) + 1),
   lambda i: (CAST(embedding[i] AS DOUBLE) - v[i]) * (CAST(embedding[i] AS DOUBLE) - v[i]))) AS d FROM embeddings, cc),
m1 AS (SELECT vec_id, CAST(label AS BIGINT) AS label, min(d) AS least, {_DIST} FROM dd GROUP BY ALL),
m0 AS (SELECT vec_id, label, CAST(CASE {_PRED} END AS BIGINT) AS pred, {_EXP} FROM m1),
m AS (SELECT vec_id, label, pred, {", ".join(f"round(e{c} / ({_TOT}), 9) AS p{c}" for c in CLASSES)} FROM m0)"""
_LONG = " UNION ALL ".join(f"SELECT label, {c} AS cls, p{c} AS p FROM m" for c in CLASSES)
LAGS_SQL = """p AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS close
  FROM orders GROUP BY 1, 2),
l AS (SELECT series, close, lead(close) OVER w AS label,
   count(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n,
   avg(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mean_10,
   avg(close) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean_3
  FROM p WINDOW w AS (PARTITION BY series ORDER BY date)),
e AS (SELECT series, 'last_value' AS model, close AS pred, label FROM l WHERE n = 10 AND label IS NOT NULL
  UNION ALL SELECT series, 'mean_3', mean_3, label FROM l WHERE n = 10 AND label IS NOT NULL
  UNION ALL SELECT series, 'mean_10', mean_10, label FROM l WHERE n = 10 AND label IS NOT NULL)"""

ORACLE = {
    "confusion_matrix": f"""WITH {MC_SQL}
SELECT label, {", ".join(f"count(*) FILTER (WHERE pred = {c}) AS pred_{c}" for c in CLASSES)} FROM m GROUP BY label""",
    "clf_metrics": f"""WITH {MC_SQL},
cls AS (SELECT label AS cls FROM m UNION SELECT pred FROM m),
pc AS (SELECT cls.cls, (SELECT count(*) FROM m WHERE label = cls.cls) AS support,
              (SELECT count(*) FROM m WHERE pred = cls.cls) AS predicted,
              (SELECT count(*) FROM m WHERE pred = cls.cls AND label = cls.cls) AS tp FROM cls),
f AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS pr,
                CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rc FROM pc),
f1 AS (SELECT avg(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END) AS macro_f1 FROM f),
lg AS ({_LONG}),
c AS (SELECT cls, p, sum(CASE WHEN label = cls THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label = cls THEN 0 ELSE 1 END) AS neg FROM lg GROUP BY cls, p),
r AS (SELECT *, sum(pos) OVER (PARTITION BY cls ORDER BY p DESC) AS cum_pos,
        sum(pos) OVER (PARTITION BY cls) AS PP, sum(neg) OVER (PARTITION BY cls) AS NN FROM c),
auc AS (SELECT cls, sum(neg * (2 * cum_pos - pos) / (2.0 * PP * NN)) AS auc, max(PP) AS support FROM r GROUP BY cls),
wa AS (SELECT sum(auc * support) / sum(support) AS weighted_auc FROM auc)
SELECT (SELECT count(*) FROM m) AS n,
  round((SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM m), 6) AS accuracy,
  round((SELECT macro_f1 FROM f1), 6) AS macro_f1, round((SELECT weighted_auc FROM wa), 6) AS weighted_auc""",
    "roc_auc_per_class": f"""WITH {MC_SQL},
lg AS ({_LONG}),
c AS (SELECT cls, p, sum(CASE WHEN label = cls THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label = cls THEN 0 ELSE 1 END) AS neg FROM lg GROUP BY cls, p),
r AS (SELECT *, sum(pos) OVER (PARTITION BY cls ORDER BY p DESC) AS cum_pos,
        sum(pos) OVER (PARTITION BY cls) AS PP, sum(neg) OVER (PARTITION BY cls) AS NN FROM c)
SELECT CAST(cls AS INTEGER) AS cls, round(sum(neg * (2 * cum_pos - pos) / (2.0 * PP * NN)), 6) AS auc,
  CAST(max(PP) AS BIGINT) AS support FROM r GROUP BY cls""",
    "roc_points": f"""WITH {BIN_SQL}
SELECT threshold, pos, neg, round(cum_pos / P, 6) AS tpr, round(cum_neg / N, 6) AS fpr FROM r""",
    "roc_auc": f"""WITH {BIN_SQL}
SELECT round(sum(neg * (2 * cum_pos - pos) / (2.0 * P * N)), 6) AS auc FROM r""",
    "regression_metrics": """WITH ev AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, avg(value) AS close
  FROM events GROUP BY 1, 2),
l AS (SELECT series, lead(close) OVER w AS label,
   sum(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) / 10 AS pred,
   count(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
  FROM ev WINDOW w AS (PARTITION BY series ORDER BY date))
SELECT series, count(*) AS n, round(avg(abs(pred - label)), 6) AS mae, round(avg((pred - label) * (pred - label)), 6) AS mse,
  round(sqrt(avg((pred - label) * (pred - label))), 6) AS rmse FROM l WHERE n = 10 AND label IS NOT NULL GROUP BY series""",
    "leaderboard": f"""WITH {LAGS_SQL}
SELECT series, model, round(avg(abs(pred - label)), 4) AS mae, round(sqrt(avg((pred - label) * (pred - label))), 4) AS rmse
FROM e GROUP BY series, model ORDER BY mae, series, model LIMIT 10""",
    "accuracy": f"""WITH {MC_SQL}
SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(1 - avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS error_rate, count(*) AS n FROM m""",
}
