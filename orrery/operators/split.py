"""Reproducible splits (survey G7-G9, G11, C6).

Rows are ordered by ``md5(seed || key)`` — the same in Spark and in any SQL engine
and independent of partitioning — instead of ``rand()``/``randomSplit``, whose
result changes when the input is repartitioned. A split looks for the row at its cut
(``rank_select``) instead of sorting; folds need every position and take them from the
distributed ``ranked`` (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.columns import hash_order  # noqa: F401

from orrery.operators.rank_select import MOST_BROADCAST, rows_at
from orrery.operators.skew import ranked
from orrery.session import cut_lineage


def _with_hash(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``_h`` (hash order) and ``_v``, its first 52 bits as a number that doubles hold exactly."""
    h = df.withColumn("_h", hash_order(key, seed))
    return h.withColumn("_v", F.conv(F.substring("_h", 1, 13), 16, 10).cast("long").cast("double"))


def _cuts(df: DataFrame, key: str, frac: float, seed: int, groups: list[str]) -> DataFrame:
    """groups, n and the hash and key of the last row of the first ``floor(frac * n)``."""
    keys = _with_hash(df.select(*groups, F.col(key).alias("_key")), "_key", seed)
    return rows_at(keys, "_v", ["_h", "_key"], [("cut", frac, F.floor(F.col("n") * frac) - 1)], groups)


def holdout(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42,
            out: str = "split") -> DataFrame:
    """First ``floor(frac * n)`` rows in hash order are 'train', the rest 'test'.

    The row at the cut is found by ``rank_select``, which reads the key alone; rows are then
    compared with it, without a sort or a shuffle. Rows that repeat the key at the cut are
    all 'train'."""
    cut = _cuts(df, key, frac, seed, []).select(F.col("_h").alias("_ch"), F.col("_key").alias("_ck")).first()
    if cut is None:
        return df.withColumn(out, F.lit("test"))
    h = hash_order(key, seed)
    first = (h < cut["_ch"]) | ((h == cut["_ch"]) & (F.col(key) <= F.lit(cut["_ck"])))
    return df.withColumn(out, F.when(first, F.lit("train")).otherwise(F.lit("test")))


def held_out_rows(df: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Complement of a sample: rows of ``df`` whose key is not in ``train``."""
    return df.join(train.select(key), key, "left_anti")


def stratified(df: DataFrame, key: str, label: str, frac: float = 0.8, seed: int = 42,
               out: str = "split") -> DataFrame:
    """Per class, the first ``floor(frac * n_class)`` rows in hash order are train:
    class shares are kept; a null class is one. As ``holdout``, with a cut per class: rows
    are joined to the table of cuts, which has a row per class."""
    cuts = cut_lineage(_cuts(df, key, frac, seed, [label]).select(F.col(label).alias("_l"), F.col("_h").alias("_ch"), F.col("_key").alias("_ck")))
    few = cuts.count() <= MOST_BROADCAST
    j = df.join(F.broadcast(cuts) if few else cuts, F.col(label).eqNullSafe(F.col("_l")), "left")
    h = hash_order(key, seed)
    first = (h < F.col("_ch")) | ((h == F.col("_ch")) & (F.col(key) <= F.col("_ck")))
    return j.withColumn(out, F.when(first, F.lit("train")).otherwise(F.lit("test"))).drop("_l", "_ch", "_ck")


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """fold = (position in hash order - 1) mod k: folds differ in size by at most 1."""
    r = ranked(df.withColumn("_h", hash_order(key, seed)), ["_h", key], out="_rk")
    return r.withColumn(out, F.pmod(F.col("_rk") - 1, F.lit(k)).cast("int")).drop("_h", "_rk")


def pick_one(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One reproducible 'random' row: the smallest hash (a one-pass min_by)."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    return (df.agg(F.min_by(packed, F.struct(hash_order(key, seed), F.col(key))).alias("_r"))
              .select("_r.*"))
