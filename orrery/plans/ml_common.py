"""Stand-in model inputs shared by the split / metric / classifier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import split as sp
from orrery.sources.tables import Tables

N_FEATS = 64
FEATS = [f"f{i}" for i in range(N_FEATS)]
SEED = 42


def features(spark, sf, n=N_FEATS):
    """embeddings → (vec_id, label, f0..f{n-1}) as doubles."""
    e = Tables(spark, sf).embeddings
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(n)])


def with_holdout(spark, sf, n=N_FEATS):
    return sp.holdout(features(spark, sf, n), "vec_id", 0.8, SEED)


FEATS_SQL = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(N_FEATS))
HOLDOUT_SQL = f"""feat AS (SELECT vec_id, label, {FEATS_SQL} FROM embeddings),
hrank AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}' || CAST(vec_id AS VARCHAR)), vec_id) AS rk,
                 count(*) OVER () AS n FROM feat),
ho AS (SELECT * EXCLUDE (rk, n), CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM hrank)"""
