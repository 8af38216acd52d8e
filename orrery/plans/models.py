"""Classifier group on embeddings (all 64 values, 10 classes, 80/20 holdout).
Rows-only in the driver: iterative fits; closed forms are checked in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import classify as cl
from orrery.operators import metrics as mt
from orrery.operators import models as md
from orrery.operators import split as sp
from orrery.plans.common import rnd
from orrery.plans.ml_common import FEATS, HOLDOUT_SQL, SEED, with_holdout

CLASSES = list(range(10))


def parts(spark, sf):
    h = md.assemble(with_holdout(spark, sf).withColumn("label", F.col("label").cast("double")), FEATS)
    return h.filter(F.col("split") == "train"), h.filter(F.col("split") == "test")


def _summary(pred, with_prob=True):
    p = pred.withColumn("prediction", F.col("prediction").cast("long")).withColumn("label", F.col("label").cast("long"))
    if with_prob:
        p = md.probability_columns(p)
    s = mt.classification_summary(p, "label", "prediction", {c: f"p{c}" for c in CLASSES} if with_prob else None)
    cols = ["n", rnd("accuracy", 6).alias("accuracy"), rnd("macro_f1", 6).alias("macro_f1")]
    if with_prob:
        cols.append(rnd("weighted_auc", 6).alias("weighted_auc"))
    return s.select(*cols)


def _discriminant(spark, sf, quadratic):
    train, test = parts(spark, sf)
    m = md.fit_discriminant(train, "label", FEATS, quadratic=quadratic)
    p = md.predict_discriminant(m, test, "vec_id", FEATS)
    return p.join(test.select("vec_id", F.col("label").cast("long").alias("label")), "vec_id")


def q_clf_lda(spark, sf):
    return _discriminant(spark, sf, False)


def q_clf_qda(spark, sf):
    return _discriminant(spark, sf, True)


def q_class_moments(spark, sf):
    """The statistics LDA / QDA are fitted on: per class and feature pair, the
    unbiased covariance from sums about the class means on the train rows."""
    train, _ = parts(spark, sf)
    st = md.class_scatter(train, "label", FEATS)
    p = len(FEATS)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(i * p + j).alias("at")) for i in range(p) for j in range(i, p)]))
    return st.select(F.col("label").cast("int").alias("label"), "n", "mean", "scatter", pairs.alias("s")).select(
        "label", "n", "s.i", "s.j", rnd(F.get("scatter", F.col("s.at")) / (F.col("n") - 1), 9).alias("cov"), rnd(F.get("mean", F.col("s.i")), 9).alias("mean_i"))


def logistic_cv(spark, sf):
    train, test = parts(spark, sf)
    train = cl.balanced_weights(sp.kfold(train, "vec_id", 3, SEED), "label")
    est = md.logistic()
    grid = md.param_grid(est, regParam=[0.001, 0.01, 0.1], weightCol=["weight"])
    grid = grid + md.param_grid(est, regParam=[0.001, 0.01, 0.1])
    best, table = md.grid_search(est, grid, train, fold_col="fold", num_folds=3)
    return best, table, test


def q_clf_logistic(spark, sf):
    best, _, test = logistic_cv(spark, sf)
    return _summary(best.transform(test))


def q_clf_coefficients(spark, sf):
    best, _, _ = logistic_cv(spark, sf)
    return md.coefficient_table(best, FEATS, spark)


def q_grid_search(spark, sf):
    _, table, _ = logistic_cv(spark, sf)
    return table.select("params", rnd("mean_accuracy", 6).alias("mean_accuracy"))


def q_clf_tree(spark, sf):
    train, test = parts(spark, sf)
    train = sp.kfold(train, "vec_id", 3, SEED)
    est = md.decision_tree()
    grid = md.param_grid(est, impurity=["gini", "entropy"], maxDepth=[3, 5, 8], minInstancesPerNode=[1, 4])
    best, _ = md.grid_search(est, grid, train, fold_col="fold", num_folds=3)
    return _summary(best.transform(test))


def q_clf_gbt(spark, sf):
    train, test = parts(spark, sf)
    m = md.boosted_ovr(10).fit(train)
    return _summary(m.transform(test), with_prob=False)


def forest(spark, sf, n=50):
    train, test = parts(spark, sf)
    return md.random_forest(n).fit(train), test


def q_clf_forest(spark, sf):
    m, test = forest(spark, sf)
    return _summary(m.transform(test))


def q_clf_svm(spark, sf):
    train, test = parts(spark, sf)
    n = train.count()
    m = md.svm_ovr(1.0, n).fit(train)
    return _summary(m.transform(test), with_prob=False)


def q_tree_sweep(spark, sf):
    """Forest error rate for 1..100 trees from ONE fitted 100-tree forest."""
    m, test = forest(spark, sf, 100)
    return md.forest_prefix_error(m, test, "vec_id").select("k", rnd("error_rate", 6).alias("error_rate"))


def q_gbt_sweep(spark, sf):
    """Binary boosted trees (label >= 5): test error rate and log-loss after each of
    the 20 iterations, from one fitted model."""
    from pyspark.ml.classification import GBTClassifier
    train, test = parts(spark, sf)
    binar = lambda df: df.withColumn("label", (F.col("label") >= 5).cast("double"))
    m = GBTClassifier(featuresCol="fv", labelCol="label", maxIter=20, seed=SEED).fit(binar(train))
    err = md.gbt_prefix_error(m, binar(test), "vec_id")
    loss = md.gbt_iteration_error(m, binar(test))
    return err.join(loss, "k").select(F.col("k").cast("int").alias("k"), rnd("error_rate", 6).alias("error_rate"),
                                      rnd("loss", 6).alias("loss"))


def q_feature_importance(spark, sf):
    m, _ = forest(spark, sf)
    return md.importances(m, FEATS, spark).orderBy(F.col("importance").desc(), "feature")


def q_pca_explained(spark, sf):
    train, _ = parts(spark, sf)
    ev, _ = md.pca_explained(train.drop("fv"), FEATS, 3)
    return ev.select("component", rnd("explained_variance", 6).alias("explained_variance"))


QUERIES = {
    "clf_lda": q_clf_lda,
    "clf_qda": q_clf_qda,
    "class_moments": q_class_moments,
    "clf_logistic": q_clf_logistic,
    "clf_coefficients": q_clf_coefficients,
    "grid_search": q_grid_search,
    "clf_tree": q_clf_tree,
    "clf_gbt": q_clf_gbt,
    "clf_forest": q_clf_forest,
    "clf_svm": q_clf_svm,
    "tree_sweep": q_tree_sweep,
    "gbt_sweep": q_gbt_sweep,
    "feature_importance": q_feature_importance,
    "pca_explained": q_pca_explained,
}
_LONG_SQL = " UNION ALL ".join(f"SELECT vec_id, label, {i} AS i, f{i} AS x FROM tr" for i in range(len(FEATS)))
ORACLE = {
    "class_moments": f"""WITH {HOLDOUT_SQL},
tr AS (SELECT * FROM ho WHERE split = 'train'),
lg AS ({_LONG_SQL})
SELECT a.label, count(*) AS n, a.i, b.i AS j, round(covar_samp(a.x, b.x), 9) + 0.0 AS cov,
  round(avg(a.x), 9) + 0.0 AS mean_i
FROM lg a JOIN lg b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.label, a.i, b.i""",
}


def q_logistic_grid(spark, sf):
    """The full logistic grid: C in 10^-3..10^5 (9 values) x {unweighted, balanced}
    x {multinomial, one-vs-rest}, 5-fold cross-validated accuracy (180 fits)."""
    train, _ = parts(spark, sf)
    train = cl.balanced_weights(sp.kfold(train, "vec_id", 5, SEED), "label").withColumn("w1", F.lit(1.0))
    cs = [10.0 ** e for e in range(-3, 6)]
    g = md.logistic_c_grid(train, cs, {"none": "w1", "balanced": "weight"}, "fold", 5)
    return g.select("strategy", "c", "weighting", rnd("mean_accuracy", 6).alias("mean_accuracy"))


QUERIES["logistic_grid"] = q_logistic_grid
