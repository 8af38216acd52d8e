"""Evaluation metrics as aggregations (survey D11, D12, E7, M8, M26, M27, F4).

Everything is a grouped aggregate over (label, prediction[, score]) rows, so the
metrics scale with the scored table and nothing is collected. ROC curves and AUC
use counts per distinct score and a distributed running total — no global window,
and no lag: the trapezoid between consecutive thresholds is computed from each
threshold's own counts and the running totals.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.scalar_join import attach_scalar
from orrery.operators.skew import running_total


def regression_metrics(df: DataFrame, label: str, pred: str, group: list[str] | None = None) -> DataFrame:
    e = F.col(pred) - F.col(label)
    g = df.groupBy(*(group or []))
    return g.agg(F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                 F.sqrt(F.avg(e * e)).alias("rmse"))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    ok = (F.col(label) == F.col(pred)).cast("double")
    return df.agg(F.avg(ok).alias("accuracy"), (1 - F.avg(ok)).alias("error_rate"),
                  F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list) -> DataFrame:
    """Rows = true label, one column per predicted class (explicit pivot values: no
    extra job to discover them). Truth and prediction are not swapped."""
    return (df.groupBy(label).pivot(pred, classes).agg(F.count(F.lit(1)))
              .fillna(0, subset=[str(c) for c in classes]))


def per_class_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(class, tp, fp, fn, support) for every class seen as label or prediction."""
    t = df.select(F.col(label).alias("cls"), F.lit(1).alias("_l"), F.lit(0).alias("_p"),
                  (F.col(label) == F.col(pred)).cast("int").alias("_tp"))
    p = df.select(F.col(pred).alias("cls"), F.lit(0).alias("_l"), F.lit(1).alias("_p"),
                  F.lit(0).alias("_tp"))
    u = t.unionByName(p).groupBy("cls").agg(F.sum("_l").alias("support"), F.sum("_p").alias("predicted"),
                                            F.sum("_tp").alias("tp"))
    return (u.withColumn("fp", F.col("predicted") - F.col("tp"))
             .withColumn("fn", F.col("support") - F.col("tp")))


def f1_table(df: DataFrame, label: str, pred: str) -> DataFrame:
    c = per_class_counts(df, label, pred)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    return (c.withColumn("precision", prec).withColumn("recall", rec)
             .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") /
                                      (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))))


def roc_points(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """One point per distinct score threshold (descending): the rows with score >=
    threshold are called positive. Ties share a point (range semantics). Rates of a
    class that has no row are null."""
    group = group or []
    c = df.groupBy(*group, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    c = c.withColumn("_neg_thr", -F.col("threshold"))
    c = running_total(c, ["_neg_thr"], ["pos", "neg"], partition=group, out=["cum_pos", "cum_neg"])
    tot = c.groupBy(*group).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if group:
        tot = tot.select(*[F.col(g).alias(f"__{g}") for g in group], "P", "N")
        same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group])
        c = c.join(tot, same).drop(*[f"__{g}" for g in group])
    else:
        c = attach_scalar(c, tot)
    return (c.withColumn("tpr", F.try_divide("cum_pos", "P"))
             .withColumn("fpr", F.try_divide("cum_neg", "N"))
             .drop("_neg_thr"))


def roc_auc(points: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Trapezoid area under the ROC points; equals the Mann-Whitney statistic with
    ties counted one half. All scores equal → 0.5; null without positives or negatives."""
    group = group or []
    term = F.try_divide(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos")), 2.0 * F.col("P") * F.col("N"))
    return points.groupBy(*group).agg(F.sum(term).alias("auc"))


def ovr_auc(df: DataFrame, label: str, prob_cols: dict) -> DataFrame:
    """One-vs-rest AUC per class and the prevalence-weighted average.
    ``prob_cols`` maps class value → probability column. Returns (cls, auc, support)."""
    long = df.select(F.col(label).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("cls"), F.col(v).cast("double").alias("p")) for k, v in prob_cols.items()
    ])).alias("s")).select("_y", "s.cls", "s.p")
    long = long.withColumn("_pos", (F.col("_y") == F.col("cls")).cast("int"))
    pts = roc_points(long, "_pos", "p", group=["cls"])
    auc = roc_auc(pts, ["cls"])
    sup = long.groupBy("cls").agg(F.sum("_pos").alias("support"))
    return auc.join(sup, "cls")


def classification_summary(df: DataFrame, label: str, pred: str, prob_cols: dict | None = None) -> DataFrame:
    """accuracy, macro F1 (unweighted mean over classes), one-vs-rest AUC weighted by
    support over the classes that have positives and negatives (null if none has)."""
    acc = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))
    f1 = f1_table(df, label, pred).agg(F.avg("f1").alias("macro_f1"))
    out = attach_scalar(acc, f1)
    if prob_cols:
        a = ovr_auc(df, label, prob_cols).agg(
            F.try_divide(F.sum(F.col("auc") * F.col("support")), F.sum(F.when(F.col("auc").isNotNull(), F.col("support")))).alias("weighted_auc"))
        out = attach_scalar(out, a)
    return out


def leaderboard(df: DataFrame, order: list, n: int = 10) -> DataFrame:
    """Ranked results, head n: a bounded top-k (TakeOrdered keeps n rows per task)."""
    return df.orderBy(*order).limit(n)

