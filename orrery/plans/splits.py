"""Split group on embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import split as sp
from orrery.plans.ml_common import SEED, features


def q_holdout_anti(spark, sf):
    f = features(spark, sf).select("vec_id", "label")
    train = sp.holdout(f, "vec_id", 0.8, SEED).filter(F.col("split") == "train")
    return sp.held_out_rows(f, train, "vec_id")


def q_stratified_split(spark, sf):
    f = features(spark, sf).select("vec_id", "label")
    return sp.stratified(f, "vec_id", "label", 0.8, SEED)


def q_kfold_assign(spark, sf):
    f = features(spark, sf).select("vec_id", "label")
    return sp.kfold(f, "vec_id", 5, SEED)


def q_pick_one(spark, sf):
    f = features(spark, sf).select("vec_id", "label")
    return sp.pick_one(f, "vec_id", SEED)


QUERIES = {
    "holdout_anti": q_holdout_anti,
    "stratified_split": q_stratified_split,
    "kfold_assign": q_kfold_assign,
    "pick_one": q_pick_one,
}

_H = f"md5('{SEED}' || CAST(vec_id AS VARCHAR)), vec_id"
ORACLE = {
    "holdout_anti": f"""SELECT vec_id, label FROM (
  SELECT vec_id, label, row_number() OVER (ORDER BY {_H}) AS rk, count(*) OVER () AS n FROM embeddings)
WHERE rk > floor(n * 0.8)""",
    "stratified_split": f"""SELECT vec_id, label, CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {_H}) AS rk,
         count(*) OVER (PARTITION BY label) AS n FROM embeddings)""",
    "kfold_assign": f"""SELECT vec_id, label, CAST((row_number() OVER (ORDER BY {_H}) - 1) % 5 AS INTEGER) AS fold
FROM embeddings""",
    "pick_one": f"SELECT vec_id, label FROM embeddings ORDER BY {_H} LIMIT 1",
}
