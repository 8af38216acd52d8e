"""Nearest-centroid scores over whole vectors against NumPy and on a planted separable table."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orrery.operators import classify as cl
from orrery.operators import metrics as mt

SCHEMA = "id long, label long, v array<double>"


def brute(rows, classes):
    x = {i: np.array(v) for i, _, v in rows if v is not None}
    mean = {k: np.mean([x[i] for i, y, v in rows if y == k and v is not None], axis=0) for k in classes if any(y == k for _, y, _ in rows)}
    out = {}
    for i, v in x.items():
        d = {k: ((v - m) ** 2).sum() for k, m in mean.items()}
        e = {k: np.exp(min(d.values()) - d[k]) if k in d else 0.0 for k in classes}
        out[i] = (min(d, key=lambda k: (round(d[k], 9), k)), [e[k] / sum(e.values()) for k in classes])
    return out


def test_scores_equal_brute_force_on_embeddings(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    want = brute([tuple(r) for r in e.collect()], list(range(10)))
    for r in cl.centroid_scores(e, "label", "v", list(range(10))).collect():
        pred, scores = want[r["id"]]
        assert r["pred"] == pred and np.allclose([r[f"p{k}"] for k in range(10)], scores, atol=1e-8)


def test_the_last_position_decides_and_separable_classes_are_told_apart(spark):
    # classes differ in the last of 70 positions only: a prefix of the vector could not tell them
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [*rng.normal(0, 0.01, 69).tolist(), float(10 * (i % 3)) + rng.normal(0, 0.1)]) for i in range(90)]
    got = cl.centroid_scores(spark.createDataFrame(rows, SCHEMA), "label", "v", [0, 1, 2])
    assert mt.accuracy(got, "label", "pred").first()["accuracy"] == 1.0


def test_absent_class_null_vector_ties_and_empty(spark):
    rows = [(1, 0, [0.0, 0.0]), (2, 1, [2.0, 0.0]), (3, None, [1.0, 0.0]), (4, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r for r in cl.centroid_scores(df, "label", "v", [0, 1, 2]).collect()}
    assert got[1]["pred"] == 0 and got[2]["pred"] == 1 and got[3]["pred"] == 0  # 3 lies between: the first class
    assert got[3]["p0"] == got[3]["p1"] == 0.5 and {got[i]["p2"] for i in (1, 2, 3)} == {0.0}
    assert got[4]["pred"] is None and got[4]["p0"] is None
    assert cl.centroid_scores(df.limit(0), "label", "v", [0, 1]).count() == 0
