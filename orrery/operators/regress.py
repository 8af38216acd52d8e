"""Penalised regression from sufficient statistics, GLM, Wald test (survey M10-M13,
M29-M31, H12).

Elastic net by coordinate descent needs only the Gram matrix: with standardised
features the update for coefficient j is

    rho_j = b_j + ((X'y)_j - (X'X b)_j) / n,   b_j = S(rho_j, l1) / (1 + 2 l2)

(S = soft threshold). So the data are read ONCE, as one grouped aggregation that
produces n, Σx, Σy, Σxx', Σxy, Σy² per group (run × set); the descent and every
MSE then run on those p×p numbers in a pandas function per run. Work on the rows
grows with the data; the per-group state is p² numbers whatever the row count.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.columns import AS_B, AS_P, normal_cdf, soft_threshold  # noqa: F401
from orrery.session import cut_lineage


# ---------------------------------------------------------------- scalar helpers


def wald_two_prop(df: DataFrame, n1: str, k1: str, n2: str, k2: str) -> DataFrame:
    """Wald test of equal proportions: z = (p1-p2)/sqrt(p1q1/n1 + p2q2/n2), two-sided p;
    null without trials on a side or without variance."""
    p1 = F.try_divide(F.col(k1), F.col(n1))
    p2 = F.try_divide(F.col(k2), F.col(n2))
    se = F.sqrt(F.try_divide(p1 * (1 - p1), F.col(n1)) + F.try_divide(p2 * (1 - p2), F.col(n2)))
    z = F.when(se > 0, F.try_divide(p1 - p2, se))
    return (df.withColumn("p1", p1).withColumn("p2", p2).withColumn("z", z)
              .withColumn("p_value", 2 * (1 - normal_cdf(F.abs(F.col("z"))))))


# ---------------------------------------------------------------- sufficient statistics

def gram_stats(df: DataFrame, y: str, xs: list[str], group: list[str]) -> DataFrame:
    """One row per group: n, the means c_i and cy, and the sums of the differences from
    them: sx_i, sy, sxx_i_j (i <= j), sxy_i, syy.

    Two passes: the means first, then products of differences, so a large mean costs no
    precision. Null groups are a group.
    """
    p = len(xs)
    means = df.groupBy(*group).agg(*[F.avg(F.col(c).cast("double")).alias(f"c_{i}") for i, c in enumerate(xs)],
                                   F.avg(F.col(y).cast("double")).alias("cy"))
    keyed = means.select(*[F.col(g).alias(f"__{g}") for g in group], *[f"c_{i}" for i in range(p)], "cy")
    d = df.join(keyed, reduce(and_, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]))
    xc = [F.col(c).cast("double") - F.col(f"c_{i}") for i, c in enumerate(xs)]
    yc = F.col(y).cast("double") - F.col("cy")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(yc).alias("sy"), F.sum(yc * yc).alias("syy"), F.first("cy").alias("cy")]
    aggs += [F.first(f"c_{i}").alias(f"c_{i}") for i in range(p)]
    aggs += [F.sum(xc[i]).alias(f"sx_{i}") for i in range(p)]
    aggs += [F.sum(xc[i] * yc).alias(f"sxy_{i}") for i in range(p)]
    aggs += [F.sum(xc[i] * xc[j]).alias(f"sxx_{i}_{j}") for i in range(p) for j in range(i, p)]
    return d.groupBy(*group).agg(*aggs)


class Suff:
    """Sufficient statistics of one group about (cx, cy), as NumPy arrays."""

    def __init__(self, row, p: int):
        self.n = float(row["n"])
        self.cy = float(row["cy"])
        self.cx = np.array([row[f"c_{i}"] for i in range(p)], dtype=float)
        self.sy = float(row["sy"])
        self.syy = float(row["syy"])
        self.sx = np.array([row[f"sx_{i}"] for i in range(p)], dtype=float)
        self.sxy = np.array([row[f"sxy_{i}"] for i in range(p)], dtype=float)
        m = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                m[i, j] = m[j, i] = row[f"sxx_{i}_{j}"]
        self.sxx = m

    @property
    def mean(self):
        return self.cx + self.sx / self.n

    @property
    def scatter(self):
        """Sum of squares and products about the mean."""
        return self.sxx - np.outer(self.sx, self.sx) / self.n


def standardiser(s: Suff):
    """Population mean / std of x and y of the fitting set."""
    sd = np.sqrt(np.maximum(np.diag(s.scatter) / s.n, 0.0))
    sd[sd == 0] = 1.0
    sy = math.sqrt(max((s.syy - s.sy * s.sy / s.n) / s.n, 0.0)) or 1.0
    return s.mean, sd, s.cy + s.sy / s.n, sy


def centred(s: Suff, mx, sd, my, sy):
    """Z'Z, Z'v, v'v, n for z = (x - mx)/sd, v = (y - my)/sy over the rows of ``s``."""
    d, dx, dy = 1.0 / sd, s.cx - mx, s.cy - my
    zz = (s.sxx + np.outer(dx, s.sx) + np.outer(s.sx, dx) + s.n * np.outer(dx, dx)) * np.outer(d, d)
    zv = (s.sxy + dy * s.sx + dx * s.sy + s.n * dx * dy) * d / sy
    vv = (s.syy + 2 * dy * s.sy + s.n * dy * dy) / (sy * sy)
    return zz, zv, vv, s.n


def coordinate_descent(zz, zv, n, l1: float, l2: float, max_iter: int = 100, tol: float = 1e-6):
    """Cyclic coordinate descent on the Gram form; returns (betas, history, sweeps).
    history[k] = betas after sweep k (row 0 = the zero start)."""
    p = len(zv)
    b = np.zeros(p)
    hist = [b.copy()]
    it = 0
    for it in range(1, max_iter + 1):
        prev = b.copy()
        for j in range(p):
            rho = b[j] + (zv[j] - zz[j] @ b) / n
            shrunk = abs(rho) - l1
            b[j] = math.copysign(shrunk, rho) / (1 + 2 * l2) if shrunk > 0 else 0.0
        hist.append(b.copy())
        if np.max(np.abs(b - prev)) < tol:
            break
    return b, np.array(hist), it


def sse(zz, zv, vv, b) -> float:
    return float(vv - 2 * b @ zv + b @ zz @ b)


# ---------------------------------------------------------------- Spark entry points

def elastic_net(df: DataFrame, y: str, xs: list[str], l1: float, l2: float,
                max_iter: int = 100, tol: float = 1e-6, group: list[str] | None = None) -> DataFrame:
    """Fit per group (or once): long table (group…, sweep, feature, beta) holding the
    whole coefficient history; the last sweep is the fit. Features and label are
    standardised with the population moments of the group."""
    group = group or []
    p = len(xs)
    g = gram_stats(df, y, xs, group) if group else gram_stats(df.withColumn("_g", F.lit(0)), y, xs, ["_g"])
    keys = group or ["_g"]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        s = Suff(row, p)
        zz, zv, vv, n = centred(s, *standardiser(s))
        b, hist, _ = coordinate_descent(zz, zv, n, l1, l2, max_iter, tol)
        out = [{**{k: row[k] for k in keys}, "sweep": k, "feature": xs[j], "beta": float(hist[k, j])}
               for k in range(len(hist)) for j in range(p)]
        return pd.DataFrame(out)

    schema = ", ".join([f"{k} {dict(g.dtypes)[k]}" for k in keys] + ["sweep int", "feature string", "beta double"])
    res = g.groupBy(*keys).applyInPandas(fit, schema)
    return res.drop("_g") if not group else res


def reg_path(df: DataFrame, y: str, xs: list[str], run: str, set_col: str,
             l1_grid: list[float], l2_grid: list[float], max_iter: int = 50, tol: float = 1e-6):
    """Penalty grid × runs. Per run the Gram of the 'train', 'validation' and 'test'
    rows is computed by one aggregation; each (l1, l2) is fitted on train and
    scored on all three sets from their statistics. Returns (mse, betas):
    mse = (run, l1, l2, set, mse), betas = (run, l1, l2, feature, beta). The fits are
    written once (runs x grid rows), so reading both tables does not read ``df`` again."""
    p = len(xs)
    g = gram_stats(df, y, xs, [run, set_col])
    grid = list(itertools.product(l1_grid, l2_grid))

    def fit_run(pdf: pd.DataFrame) -> pd.DataFrame:
        stats = {r[set_col]: Suff(r, p) for _, r in pdf.iterrows()}
        r_id = pdf[run].iloc[0]
        if "train" not in stats:
            return pd.DataFrame(columns=["run", "l1", "l2", "kind", "name", "value"])
        st = standardiser(stats["train"])
        cen = {k: centred(v, *st) for k, v in stats.items()}
        zz, zv, _, n = cen["train"]
        out = []
        for l1, l2 in grid:
            b, _, _ = coordinate_descent(zz, zv, n, l1, l2, max_iter, tol)
            for name, (a, c, vv, m) in cen.items():
                out.append((r_id, l1, l2, "mse", name, sse(a, c, vv, b) / m))
            for j in range(p):
                out.append((r_id, l1, l2, "beta", xs[j], float(b[j])))
        return pd.DataFrame(out, columns=["run", "l1", "l2", "kind", "name", "value"])

    res = cut_lineage(g.groupBy(run).applyInPandas(
        fit_run, "run long, l1 double, l2 double, kind string, name string, value double"))
    mse = res.filter(F.col("kind") == "mse").select("run", "l1", "l2", F.col("name").alias("set"),
                                                    F.col("value").alias("mse"))
    betas = res.filter(F.col("kind") == "beta").select("run", "l1", "l2", F.col("name").alias("feature"),
                                                       F.col("value").alias("beta"))
    return mse, betas


def reg_path_select(mse: DataFrame, betas: DataFrame) -> DataFrame:
    """Mean ± standard error of validation and test MSE per (l1, l2); the pair with
    the lowest mean validation MSE (ties: smaller l1, then l2) with its test MSE
    and mean betas (one column per feature)."""
    s = mse.groupBy("l1", "l2").pivot("set", ["validation", "test", "train"]).agg(
        F.avg("mse").alias("mean"), (F.stddev_samp("mse") / F.sqrt(F.count("mse"))).alias("se"))
    best = s.agg(F.min_by(F.struct("l1", "l2"), F.struct("validation_mean", "l1", "l2")).alias("b")).select("b.*")
    chosen = s.join(best, ["l1", "l2"])
    feats = [r[0] for r in betas.select("feature").distinct().collect()]  # p names
    mb = betas.join(best, ["l1", "l2"]).groupBy("l1", "l2").pivot("feature", sorted(feats)).agg(F.avg("beta"))
    return chosen.join(mb, ["l1", "l2"])


# ---------------------------------------------------------------- binomial GLM

def fit_binomial_glm(df: DataFrame, label: str, features_col: str = "features", weight: str | None = None,
                     max_iter: int = 25):
    """Binomial GLM (logit link) by IRLS. ``weight`` lets grouped counts stand for
    expanded trial rows: one row per (group, outcome) weighted by its count gives
    the same coefficients as one row per trial."""
    from pyspark.ml.regression import GeneralizedLinearRegression
    glr = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label,
                                      featuresCol=features_col, maxIter=max_iter)
    if weight:
        glr = glr.setWeightCol(weight)
    return glr.fit(df)


def glm_coefficients(model, names: list[str], spark) -> DataFrame:
    """(term, estimate, std_error, z_value, p_value) from the fitted model summary
    (a model-size table built on the driver)."""
    s = model.summary
    terms = names + ["(Intercept)"] if model.getFitIntercept() else names
    est = list(model.coefficients.toArray()) + ([model.intercept] if model.getFitIntercept() else [])
    rows = list(zip(terms, [float(v) for v in est], [float(v) for v in s.coefficientStandardErrors],
                    [float(v) for v in s.tValues], [float(v) for v in s.pValues]))
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, z_value double, p_value double")
