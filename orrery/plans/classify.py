"""Closed-form classifiers on embeddings (all 64 values, 10 classes), 80/20 holdout."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import classify as cl
from orrery.plans.common import rnd
from orrery.plans.ml_common import FEATS, HOLDOUT_SQL, N_FEATS, with_holdout

K = 5
K_MAX = 39


def _parts(spark, sf):
    h = with_holdout(spark, sf)
    return h.filter(F.col("split") == "train"), h.filter(F.col("split") == "test")


def q_standardize(spark, sf):
    h = with_holdout(spark, sf)
    m = cl.fit_standard(h.filter(F.col("split") == "train"), FEATS)
    z = cl.apply_standard(h, m, FEATS)
    return z.select("vec_id", "split", *[rnd(f"z_{c}", 6).alias(f"z_{c}") for c in FEATS])


def q_balanced_weights(spark, sf):
    h = with_holdout(spark, sf).select("vec_id", "label")
    return cl.balanced_weights(h, "label").select("vec_id", "label", rnd("weight", 6).alias("weight"))


def neighbours(spark, sf, k):
    train, test = _parts(spark, sf)
    return cl.knn_neighbors(train, test, "vec_id", "label", FEATS, k), test


def q_knn_vote(spark, sf):
    nb, test = neighbours(spark, sf, K)
    p = cl.knn_vote(nb)
    return p.join(test.select(F.col("vec_id").alias("test_id"), "label"), "test_id").select(
        F.col("test_id").alias("vec_id"), "label", F.col("pred").cast("int").alias("pred"))


def q_knn_vote_weighted(spark, sf):
    """k = 5, Manhattan distance, votes weighted by 1 / distance."""
    train, test = _parts(spark, sf)
    nb = cl.knn_neighbors(train, test, "vec_id", "label", FEATS, K, metric="l1")
    p = cl.knn_vote(nb, weighted=True)
    return p.join(test.select(F.col("vec_id").alias("test_id"), "label"), "test_id").select(
        F.col("test_id").alias("vec_id"), "label", F.col("pred").cast("int").alias("pred"))


def q_knn_k_sweep(spark, sf):
    nb, test = neighbours(spark, sf, K_MAX)
    s = cl.knn_k_sweep(nb, test, "vec_id", "label", K_MAX)
    return s.select("k", rnd("accuracy", 6).alias("accuracy"), rnd("error_rate", 6).alias("error_rate"))


KNN_KS = [1, 3, 5, 6, 7, 8]


def q_knn_grid(spark, sf):
    """5-fold CV over k in {1,3,5,6,7,8} x {uniform, distance} x {euclidean, manhattan}."""
    from orrery.operators.split import kfold
    train, _ = _parts(spark, sf)
    f = kfold(train.select("vec_id", "label", *FEATS), "vec_id", 5, 42)
    g = cl.knn_cv_grid(f, "vec_id", "label", FEATS, "fold", KNN_KS)
    return g.select("metric", "weighting", F.col("k").cast("int").alias("k"), rnd("mean_accuracy", 6).alias("mean_accuracy"))


def q_clf_nb(spark, sf):
    train, test = _parts(spark, sf)
    m = cl.fit_gaussian_nb(train, "label", FEATS)
    p = cl.predict_gaussian_nb(m, test, "vec_id", FEATS)
    return p.join(test.select("vec_id", "label"), "vec_id").select(
        "vec_id", "label", F.col("pred").cast("int").alias("pred"))


QUERIES = {
    "standardize": q_standardize,
    "balanced_weights": q_balanced_weights,
    "knn_vote": q_knn_vote,
    "knn_vote_weighted": q_knn_vote_weighted,
    "knn_k_sweep": q_knn_k_sweep,
    "knn_grid": q_knn_grid,
    "clf_nb": q_clf_nb,
}

_DIST = " + ".join(f"(t.f{i} - r.f{i}) * (t.f{i} - r.f{i})" for i in range(N_FEATS))
NB_SQL = f"""{HOLDOUT_SQL},
tr AS (SELECT * FROM ho WHERE split = 'train'), te AS (SELECT * FROM ho WHERE split = 'test'),
nb AS (SELECT t.vec_id, t.label, r.vec_id AS nb_id, r.label AS nb_label,
         row_number() OVER (PARTITION BY t.vec_id ORDER BY {_DIST}, r.vec_id) AS nb_rank
       FROM te t, tr r)"""
_L1 = " + ".join(f"abs(t.f{i} - r.f{i})" for i in range(N_FEATS))
NB1_SQL = f"""{HOLDOUT_SQL},
tr AS (SELECT * FROM ho WHERE split = 'train'), te AS (SELECT * FROM ho WHERE split = 'test'),
d AS (SELECT t.vec_id, t.label, r.vec_id AS nb_id, r.label AS nb_label, {_L1} AS dist FROM te t, tr r),
nb AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb_id) AS nb_rank FROM d)"""
_LONG_TR = " UNION ALL ".join(f"SELECT label AS cls, {i} AS j, f{i} AS x FROM tr" for i in range(N_FEATS))
_LONG_TE = " UNION ALL ".join(f"SELECT vec_id, label, {i} AS j, f{i} AS x FROM te" for i in range(N_FEATS))

_KNN_GRID_SQL = f"""{HOLDOUT_SQL},
tr0 AS (SELECT * FROM ho WHERE split = 'train'),
fo AS (SELECT *, CAST((row_number() OVER (ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) - 1) % 5 AS INTEGER) AS fold
       FROM tr0),
pr AS (SELECT t.fold, t.vec_id, t.label, r.vec_id AS nb_id, r.label AS nb_label,
         {_DIST} AS d2, {" + ".join(f"abs(t.f{i} - r.f{i})" for i in range(N_FEATS))} AS d1
       FROM fo t JOIN fo r ON t.fold <> r.fold),
m AS (SELECT fold, vec_id, label, nb_id, nb_label, 'l2' AS metric, sqrt(d2) AS dist,
         row_number() OVER (PARTITION BY fold, vec_id ORDER BY d2, nb_id) AS nb_rank FROM pr
      UNION ALL
      SELECT fold, vec_id, label, nb_id, nb_label, 'l1', d1,
         row_number() OVER (PARTITION BY fold, vec_id ORDER BY d1, nb_id) FROM pr),
ks AS (SELECT unnest([{", ".join(str(k) for k in KNN_KS)}]) AS k),
wt AS (SELECT unnest(['uniform', 'distance']) AS weighting),
v AS (SELECT metric, weighting, k, fold, vec_id, label, nb_label,
        sum(CASE WHEN weighting = 'uniform' THEN 1.0 ELSE 1.0 / dist END) AS votes
      FROM m JOIN ks ON m.nb_rank <= ks.k CROSS JOIN wt GROUP BY ALL),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY metric, weighting, k, fold, vec_id
                                                  ORDER BY votes DESC, nb_label) AS rn FROM v) WHERE rn = 1),
fa AS (SELECT metric, weighting, k, fold, avg(CASE WHEN nb_label = label THEN 1.0 ELSE 0.0 END) AS acc
       FROM p GROUP BY ALL)"""

ORACLE = {
    "knn_grid": f"""WITH {_KNN_GRID_SQL}
SELECT metric, weighting, CAST(k AS INTEGER) AS k, round(avg(acc), 6) AS mean_accuracy FROM fa GROUP BY metric, weighting, k""",
    "standardize": f"""WITH {HOLDOUT_SQL},
m AS (SELECT {", ".join(f"avg(f{i}) AS mu{i}, stddev_pop(f{i}) AS sd{i}" for i in range(N_FEATS))} FROM ho WHERE split = 'train')
SELECT vec_id, split, {", ".join(f"round(CASE WHEN sd{i} = 0 THEN 0.0 ELSE (f{i} - mu{i}) / sd{i} END, 6) AS z_f{i}" for i in range(N_FEATS))}
FROM ho, m""",
    "balanced_weights": f"""WITH {HOLDOUT_SQL},
c AS (SELECT label, count(*) AS nc FROM ho GROUP BY label)
SELECT vec_id, ho.label, round((SELECT sum(nc) FROM c) / ((SELECT count(*) FROM c) * nc), 6) AS weight
FROM ho JOIN c USING (label)""",
    "knn_vote": f"""WITH {NB_SQL},
v AS (SELECT vec_id, label, nb_label, count(*) AS votes FROM nb WHERE nb_rank <= {K} GROUP BY 1, 2, 3)
SELECT vec_id, label, CAST(nb_label AS INTEGER) AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, nb_label) AS rn FROM v) WHERE rn = 1""",
    "knn_vote_weighted": f"""WITH {NB1_SQL},
v AS (SELECT vec_id, label, nb_label, sum(1.0 / dist) AS votes FROM nb WHERE nb_rank <= {K} GROUP BY 1, 2, 3)
SELECT vec_id, label, CAST(nb_label AS INTEGER) AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, nb_label) AS rn FROM v) WHERE rn = 1""",
    "knn_k_sweep": f"""WITH {NB_SQL},
ks AS (SELECT * FROM range(1, {K_MAX + 1}) t(k)),
v AS (SELECT k, vec_id, label, nb_label, count(*) AS votes FROM nb JOIN ks ON nb.nb_rank <= ks.k GROUP BY 1, 2, 3, 4),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, vec_id ORDER BY votes DESC, nb_label) AS rn FROM v) WHERE rn = 1)
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN nb_label = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(1 - avg(CASE WHEN nb_label = label THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM p GROUP BY k""",
    "clf_nb": f"""WITH {HOLDOUT_SQL},
tr AS (SELECT * FROM ho WHERE split = 'train'), te AS (SELECT * FROM ho WHERE split = 'test'),
ltr AS ({_LONG_TR}), lte AS ({_LONG_TE}),
eps AS (SELECT max(v) * 1e-9 AS e FROM (SELECT j, var_pop(x) AS v FROM ltr GROUP BY j)),
st AS (SELECT cls, j, avg(x) AS mu, var_pop(x) + (SELECT e FROM eps) AS var,
        ln(count(*) / (SELECT count(*) FROM tr)) AS log_prior FROM ltr GROUP BY cls, j),
s AS (SELECT vec_id, label, cls, max(log_prior) + sum(-0.5 * (ln(2 * pi()) + ln(var)) - 0.5 * (x - mu) ** 2 / var) AS jll
      FROM lte JOIN st USING (j) GROUP BY vec_id, label, cls)
SELECT vec_id, label, CAST(cls AS INTEGER) AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY jll DESC, cls) AS rn FROM s) WHERE rn = 1""",
}
