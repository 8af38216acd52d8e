"""Spark ML classifiers, grid search, discriminant analysis, PCA (survey M4, M14-M17,
M20-M22, M24, M25, M37, F5).

Built-in estimators do the fitting distributed. Discriminant analysis is a
closed form: class means and (pooled or per-class) covariance come from ONE
grouped aggregation of x and x·xᵀ sums; the p×p algebra is model-size and runs
in NumPy; scoring ships the model as a broadcast parameter into a vectorised
pandas function per partition.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import cut_lineage



def assemble(df: DataFrame, feats: list[str], out: str = "fv") -> DataFrame:
    return VectorAssembler(inputCols=feats, outputCol=out).transform(df)


ROWS_PER_PARTITION = 50_000  # of a training table that many small fits read


def accuracy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def grid_search(est, grid: list, train: DataFrame, fold_col: str | None = None, num_folds: int = 5,
                parallelism: int = 1, seed: int = 42):
    """k-fold cross-validated grid; returns (best model, grid DataFrame of
    (params, mean accuracy, std)).

    The fits read a checkpoint of the training table, so none of them plans or broadcasts
    anything, and run one after another: each is a distributed job of its own."""
    n = train.count()
    train = cut_lineage(train.repartition(max(1, -(-n // ROWS_PER_PARTITION))))
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=accuracy_evaluator(),
                        numFolds=num_folds, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    m = cv.fit(train)
    rows = []
    stds = getattr(m, "stdMetrics", None) or [None] * len(grid)
    for pm, avg, sd in zip(grid, m.avgMetrics, stds):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((desc, float(avg), None if sd is None else float(sd)))
    spark = train.sparkSession
    g = spark.createDataFrame(rows, "params string, mean_accuracy double, std_accuracy double")
    return m.bestModel, g




def logistic_c_grid(train: DataFrame, cs: list[float], weight_cols: dict, fold_col: str, num_folds: int,
                    parallelism: int = 8, max_iter: int = 20) -> DataFrame:
    """Grid over inverse regularisation C, class weighting and the multiclass strategy
    (multinomial softmax or one-vs-rest binary fits): (strategy, c, weighting,
    mean_accuracy), the mean over folds of the held-out accuracy.

    ``weight_cols`` maps a weighting name to a weight column. Per strategy and weighting
    one ``CrossValidator`` over regParam = 1 / (C · rows of a training fold), its fits in
    parallel on the cached table ``fv``, ``label``, weights and fold."""
    spark, n = train.sparkSession, train.count()
    train = train.select("fv", F.col("label").cast("double").alias("label"), fold_col, *weight_cols.values())
    train = train.repartition(max(1, -(-n // ROWS_PER_PARTITION))).persist()
    rows = []
    try:
        for name, col in weight_cols.items():
            lr = LogisticRegression(featuresCol="fv", labelCol="label", weightCol=col, maxIter=max_iter, standardization=False)
            for strategy, est in (("multinomial", lr.copy({lr.family: "multinomial"})),
                                  ("ovr", OneVsRest(classifier=lr, featuresCol="fv", labelCol="label", weightCol=col))):
                grid = [{lr.regParam: num_folds / (c * n * (num_folds - 1))} for c in cs]
                cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=accuracy_evaluator(), numFolds=num_folds,
                                    foldCol=fold_col, parallelism=parallelism)
                rows += [(strategy, float(c), name, float(a)) for c, a in zip(cs, cv.fit(train).avgMetrics)]
    finally:
        train.unpersist()
    return spark.createDataFrame(rows, "strategy string, c double, weighting string, mean_accuracy double")


def logistic(weight_col: str | None = None, family: str = "multinomial"):
    lr = LogisticRegression(featuresCol="fv", labelCol="label", family=family, maxIter=100)
    return lr.setWeightCol(weight_col) if weight_col else lr


def decision_tree(seed: int = 42):
    return DecisionTreeClassifier(featuresCol="fv", labelCol="label", seed=seed)


def random_forest(n: int = 50, seed: int = 42):
    return RandomForestClassifier(featuresCol="fv", labelCol="label", numTrees=n, seed=seed)


def boosted_ovr(max_iter: int = 10, seed: int = 42, parallelism: int = 10):
    """Multiclass boosted trees as one-vs-rest binary GBTs (the per-class fits run
    concurrently)."""
    return OneVsRest(classifier=GBTClassifier(maxIter=max_iter, seed=seed), featuresCol="fv", labelCol="label",
                     parallelism=parallelism)


def svm_ovr(c: float = 1.0, n: int = 1, parallelism: int = 10, max_iter: int = 50):
    """Linear SVM, one-vs-rest; C maps to regParam = 1 / (n C). Per-class fits run
    concurrently."""
    return OneVsRest(classifier=LinearSVC(regParam=1.0 / (n * c), maxIter=max_iter, tol=1e-4), featuresCol="fv",
                     labelCol="label", parallelism=parallelism)


def coefficient_table(model, feats: list[str], spark) -> DataFrame:
    """(class, feature, coefficient) long table from a multinomial model."""
    m = model.coefficientMatrix.toArray()
    rows = [(int(k), feats[j], float(m[k, j])) for k in range(m.shape[0]) for j in range(m.shape[1])]
    rows += [(int(k), "(intercept)", float(v)) for k, v in enumerate(model.interceptVector.toArray())]
    return spark.createDataFrame(rows, "class int, feature string, coefficient double")


def importances(model, feats: list[str], spark) -> DataFrame:
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(feats, imp)], "feature string, importance double")


def _chain_trees(trees, test: DataFrame, keep: list[str], out: str) -> DataFrame:
    """One scan of ``test``: every tree adds one output column (``out`` =
    "prediction" or "probability") as a narrow projection; other outputs off."""
    cur = test.select(*keep, "fv")
    for i, t in enumerate(trees):
        m = t.copy()
        for param in ("predictionCol", "rawPredictionCol", "probabilityCol"):
            if m.hasParam(param):
                m = m._set(**{param: f"_o{i}" if param == f"{out}Col" else ""})
        cur = m.transform(cur)
    return cur


def forest_prefix_error(model, test: DataFrame, id_col: str, max_trees: int | None = None) -> DataFrame:
    """Error rate of the forest made of its first k trees, k = 1..n, from ONE
    fitted forest. As the forest itself, the prefix predicts the class with the
    largest sum of the trees' class probabilities (ties → smallest class). The
    probabilities of all trees come from one scan; the running sums are a window
    per (row, class) over the tree order."""
    trees = model.trees[: max_trees or len(model.trees)]
    cur = _chain_trees(trees, test, [id_col, "label"], "probability")
    arrs = F.array(*[vector_to_array(F.col(f"_o{i}")) for i in range(len(trees))])
    long = (cur.select(id_col, "label", F.posexplode(arrs).alias("_t", "_q"))
               .select(id_col, "label", (F.col("_t") + 1).alias("k"), F.posexplode("_q").alias("cls", "q")))
    w = Window.partitionBy(id_col, "cls").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    cum = long.withColumn("s", F.sum("q").over(w))
    pred = cum.groupBy(id_col, "label", "k").agg(
        F.max_by("cls", F.struct(F.col("s"), -F.col("cls"))).cast("double").alias("pred"))
    return pred.groupBy("k").agg((1 - F.avg((F.col("pred") == F.col("label")).cast("double"))).alias("error_rate"))


def gbt_prefix_error(model, test: DataFrame, id_col: str) -> DataFrame:
    """Misclassification error of a binary boosted model after k = 1..n iterations:
    the tree outputs come from one scan; the margin of the first k trees is a
    running weighted sum (window per row over the tree order); class 1 when > 0."""
    trees, weights = model.trees, model.treeWeights
    cur = _chain_trees(trees, test, [id_col, "label"], "prediction")
    vals = F.array(*[F.col(f"_o{i}") * float(weights[i]) for i in range(len(trees))])
    long = cur.select(id_col, "label", F.posexplode(vals).alias("_t", "m")).withColumn("k", F.col("_t") + 1)
    w = Window.partitionBy(id_col).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    margin = long.withColumn("margin", F.sum("m").over(w))
    pred = (F.col("margin") > 0).cast("double")
    return margin.groupBy("k").agg((1 - F.avg((pred == F.col("label")).cast("double"))).alias("error_rate"))


def gbt_iteration_error(model, test: DataFrame) -> DataFrame:
    """Loss of a binary GBT after each boosting iteration (built-in evaluation)."""
    loss = model.evaluateEachIteration(test)  # the model's own loss (logistic)
    spark = test.sparkSession
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(loss)], "k int, loss double")


def pca_explained(df: DataFrame, feats: list[str], k: int = 3) -> tuple[DataFrame, float]:
    """PCA on standardised features; explained variance per component and its sum."""
    a = assemble(df, feats, "raw")
    sc = StandardScaler(inputCol="raw", outputCol="fv", withMean=True, withStd=True).fit(a)
    model = PCA(k=k, inputCol="fv", outputCol="pcs").fit(sc.transform(a))
    ev = [float(v) for v in model.explainedVariance.toArray()]
    spark = df.sparkSession
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(ev)], "component int, explained_variance double"), sum(ev)


# ---------------------------------------------------------------- discriminant analysis

MERGE_LEVELS = (1024, 32, 1)  # how many groups of partial statistics a class has, level by level


def _merge_moments(n, mean, scatter):
    """Counts, means and scatter matrices of parts (stacked) as those of their union."""
    total = n.sum()
    if not total:
        return 0, np.zeros(mean.shape[1]), np.zeros(scatter.shape[1:])
    middle = (n[:, None] * mean).sum(axis=0) / total
    d = mean - middle
    return int(total), middle, scatter.sum(axis=0) + (d * n[:, None]).T @ d


def class_scatter(df: DataFrame, label: str, feats: list[str] | str) -> DataFrame:
    """label (double), n, mean (array), scatter (array of p * p: sums of products of the
    differences from the mean, row by row) per class, for vectors of any width.

    Every task adds up the outer products of its rows as matrix products, one row per class;
    these are merged over a few levels, so that no task gets the statistics of all tasks.
    Means and differences are taken per batch and merged, so a large mean costs no
    precision. Rows with a null label, a null vector or a null feature are left out.
    """
    schema = pa.schema([("label", pa.float64()), ("part", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("scatter", pa.list_(pa.float64()))])
    ddl = "label double, part int, n long, mean array<double>, scatter array<double>"
    vector = F.col(feats).cast("array<double>") if isinstance(feats, str) else F.array(*[F.col(c).cast("double") for c in feats])
    rows = df.select(F.col(label).cast("double").alias("label"), vector.alias("v"))
    rows = rows.filter(F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull()))

    def table(part, found):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*[(y, part, n, m, s.ravel()) for y, (n, m, s) in found.items()]), schema)],
                                          schema=schema) if found else pa.RecordBatch.from_pylist([], schema)

    def add(batches):
        found = {}
        for b in batches:
            if not b.num_rows:
                continue
            y, x = b.column("label").to_numpy(), b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
            for c in np.unique(y):
                mine = x[y == c]
                mean = mine.mean(axis=0)
                new = (len(mine), mean, (mine - mean).T @ (mine - mean))
                found[c] = new if c not in found else _merge_moments(*(np.array(z) for z in zip(found[c], new)))
        yield table(TaskContext.get().partitionId(), found)

    def merge(t: pa.Table) -> pa.Table:
        n, p = t.column("n").to_numpy(), len(t.column("mean")[0])
        mean, scatter = (t.column(c).combine_chunks().flatten().to_numpy() for c in ("mean", "scatter"))
        part = t.column("part")[0].as_py()
        return pa.Table.from_batches([table(part, {t.column("label")[0].as_py(): _merge_moments(n, mean.reshape(-1, p), scatter.reshape(-1, p, p))})])

    out = rows.mapInArrow(add, ddl)
    for groups in MERGE_LEVELS:
        out = out.withColumn("part", F.pmod("part", F.lit(groups)).cast("int")).groupBy("label", "part").applyInArrow(merge, ddl)
    return out.drop("part")


def fit_discriminant(train: DataFrame, label: str, feats: list[str], quadratic: bool = False,
                     reg: float = 0.0) -> dict:
    """Model dict: classes, means, log priors, and either the pooled precision
    matrix (LDA) or per-class precision matrices and log-determinants (QDA).
    Covariances are unbiased (n - k, resp. n_c - 1 denominators). A class whose own
    covariance is singular (a feature constant within it, or too few rows) takes the
    pooled one in QDA."""
    st = {r["label"]: r for r in class_scatter(train, label, feats).collect()}  # a row per class
    classes = sorted(st)
    p = len(feats)
    counts = {c: st[c]["n"] for c in classes}
    n = sum(counts.values())
    means = {c: np.array(st[c]["mean"]) for c in classes}
    scat = {c: np.array(st[c]["scatter"]).reshape(p, p) for c in classes}
    pooled = sum(scat.values()) / max(n - len(classes), 1) + reg * np.eye(p)
    model = {"classes": classes, "means": np.array([means[c] for c in classes]),
             "log_prior": np.log(np.array([counts[c] / n for c in classes])), "quadratic": quadratic}
    if quadratic:
        covs = [scat[c] / max(counts[c] - 1, 1) + reg * np.eye(p) for c in classes]
        covs = [pooled if np.linalg.matrix_rank(c, hermitian=True) < p else c for c in covs]
        model["prec"] = np.array([np.linalg.pinv(c) for c in covs])
        model["logdet"] = np.array([np.linalg.slogdet(c)[1] for c in covs])
    else:
        model["prec"] = np.linalg.pinv(pooled)
    return model


def predict_discriminant(model: dict, df: DataFrame, id_col: str, feats: list[str]) -> DataFrame:
    """Vectorised scoring per partition; the model (k·p² numbers) travels in the
    closure as a broadcast parameter. Ties → smallest class."""
    classes = np.array(model["classes"])
    mu, lp, prec = model["means"], model["log_prior"], model["prec"]
    quad = model["quadratic"]
    logdet = model.get("logdet")

    def score(it):
        for pdf in it:
            x = pdf[feats].to_numpy(dtype=np.float64)
            if quad:
                s = np.stack([-0.5 * logdet[k] - 0.5 * np.einsum("ij,jk,ik->i", x - mu[k], prec[k], x - mu[k]) + lp[k]
                              for k in range(len(classes))], axis=1)
            else:
                w = mu @ prec                               # k × p
                b = -0.5 * np.einsum("kj,kj->k", w, mu) + lp
                s = x @ w.T + b
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), "pred": classes[np.argmax(s, axis=1)].astype("int64")})

    return df.select(id_col, *feats).mapInPandas(score, f"{id_col} long, pred long")


def probability_columns(df: DataFrame, prob_col: str = "probability", k: int = 10) -> DataFrame:
    arr = vector_to_array(F.col(prob_col))
    return df.select("*", *[arr[i].alias(f"p{i}") for i in range(k)])


def param_grid(est, **params):
    b = ParamGridBuilder()
    for name, values in params.items():
        b = b.addGrid(getattr(est, name), values)
    return b.build()

