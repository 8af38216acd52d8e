"""Regression group: Wald test and soft threshold (SQL-checked); binomial GLM on
grouped counts, elastic net and penalty paths from Gram statistics, rating
regression (rows-only: iterative fits)."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from orrery.operators import regress as rg
from orrery.operators import split as sp
from orrery.plans.common import rnd
from orrery.plans.relational import LI_KEY, expand_input
from orrery.sources.tables import Tables

XS = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
Y = "charge"  # l_extendedprice · (1 - l_discount) · (1 + l_tax)
L1_GRID = [round(0.1 * i, 1) for i in range(16)]
L2_GRID = [round(0.1 * i, 1) for i in range(16)]
N_RUNS = 50
SEED = 42


def q_wald_two_prop(spark, sf):
    """Per line number: do flags 'A' and 'R' have equal shares of discount >= 0.05?"""
    c = expand_input(spark, sf)
    a = c.filter(F.col("l_returnflag") == "A").groupBy("l_linenumber").agg(
        F.sum("conducted").alias("n1"), F.sum("passed").alias("k1"))
    r = c.filter(F.col("l_returnflag") == "R").groupBy("l_linenumber").agg(
        F.sum("conducted").alias("n2"), F.sum("passed").alias("k2"))
    w = rg.wald_two_prop(a.join(r, "l_linenumber"), "n1", "k1", "n2", "k2")
    return w.select("l_linenumber", "n1", "k1", "n2", "k2", *[rnd(c, 6).alias(c) for c in ["p1", "p2", "z", "p_value"]])


def q_soft_threshold(spark, sf):
    """Soft threshold of a per-part centred discount signal, l1 = 0.1, l2 = 0.2."""
    li = Tables(spark, sf).lineitem
    b = li.groupBy("l_partkey").agg((F.avg(F.col("l_discount") * 10) - 0.45).alias("b"))
    return b.select("l_partkey", rnd("b", 9).alias("b"), rnd(rg.soft_threshold(F.col("b"), 0.1, 0.2), 9).alias("st"))


def regression_rows(spark, sf):
    t = Tables(spark, sf)
    j = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice"), "l_partkey")
    # the same in any engine: leading hex digits of an MD5 of the row's key
    digits = lambda seed: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in LI_KEY])), 1, 15), 16, 10).cast("long")
    h, u = digits("run"), F.pmod(digits(str(SEED)), F.lit(10))
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return j.select(*LI_KEY, charge.alias(Y), *XS,
                    F.pmod(h, F.lit(N_RUNS)).alias("run"),
                    F.when(u < 6, "train").when(u < 8, "validation").otherwise("test").alias("set"))


def q_elastic_net(spark, sf):
    r = regression_rows(spark, sf)
    return rg.elastic_net(r, Y, XS, 0.2, 0.2)


def q_reg_path(spark, sf):
    mse, _ = rg.reg_path(regression_rows(spark, sf), Y, XS, "run", "set", L1_GRID, L2_GRID)
    return mse


def q_reg_path_select(spark, sf):
    mse, betas = rg.reg_path(regression_rows(spark, sf), Y, XS, "run", "set", L1_GRID, L2_GRID)
    return rg.reg_path_select(mse, betas)


def trial_rows(spark, sf):
    """One trial per lineitem: result = discount >= 0.05, keyed, 80/20 by hash."""
    li = Tables(spark, sf).lineitem
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in LI_KEY])
    t = li.select(key.alias("k"), "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("double").alias("line"),
                  (F.col("l_discount") >= 0.05).cast("double").alias("result"))
    return sp.holdout(t, "k", 0.8, SEED)


def _glm_design():
    si = StringIndexer(inputCols=["l_returnflag", "l_linestatus"], outputCols=["fi", "si"],
                       stringOrderType="alphabetAsc")
    oh = OneHotEncoder(inputCols=["fi", "si"], outputCols=["fo", "so"], dropLast=True)
    va = VectorAssembler(inputCols=["fo", "so", "line"], outputCol="features")
    return si, oh, va


def _grouped(train):
    """Trials collapsed to (group, outcome, count): the GLM is fitted on weights."""
    return train.groupBy("l_returnflag", "l_linestatus", "line", "result").agg(F.count(F.lit(1)).cast("double").alias("w"))


def fit_logit(spark, sf):
    t = trial_rows(spark, sf)
    train = _grouped(t.filter(F.col("split") == "train"))
    si, oh, va = _glm_design()
    sim = si.fit(train)
    ohm = oh.fit(sim.transform(train))
    design = lambda df: va.transform(ohm.transform(sim.transform(df)))
    model = rg.fit_binomial_glm(design(train).withColumnRenamed("result", "label"), "label", weight="w")
    names = [f"flag_{v}" for v in sim.labelsArray[0][:-1]] + [f"status_{v}" for v in sim.labelsArray[1][:-1]] + ["line"]
    return model, design, names, t


def q_logit_fit(spark, sf):
    model, _, names, _ = fit_logit(spark, sf)
    return rg.glm_coefficients(model, names, spark)


def q_logit_eval(spark, sf):
    model, design, _, t = fit_logit(spark, sf)
    test = design(t.filter(F.col("split") == "test"))
    p = model.transform(test).withColumn("pred", (F.col("prediction") > 0.5).cast("double"))
    return p.agg(F.count(F.lit(1)).alias("n"),
                 F.avg((F.col("pred") == F.col("result")).cast("double")).alias("accuracy"),
                 F.count_if((F.col("result") == 1) & (F.col("pred") == 1)).alias("tp"),
                 F.count_if((F.col("result") == 0) & (F.col("pred") == 1)).alias("fp"),
                 F.count_if((F.col("result") == 1) & (F.col("pred") == 0)).alias("fn"),
                 F.count_if((F.col("result") == 0) & (F.col("pred") == 0)).alias("tn"))


def q_scenario_score(spark, sf):
    """Named scenarios = every (flag, status) at line numbers 1 and 7."""
    model, design, _, t = fit_logit(spark, sf)
    sc = (t.select("l_returnflag", "l_linestatus").distinct()
           .withColumn("line", F.explode(F.array(F.lit(1.0), F.lit(7.0)))))
    return model.transform(design(sc)).select("l_returnflag", "l_linestatus", "line",
                                             F.col("prediction").alias("pass_probability"))


def q_rating_regression(spark, sf):
    from orrery.operators.recommend import ratings_table
    t = Tables(spark, sf)
    r = ratings_table(t.lineitem, t.orders, t.part).join(
        t.part.select(F.col("p_partkey").alias("item"), F.col("p_size").cast("double").alias("size")), "item")
    si = StringIndexer(inputCol="genre", outputCol="gi", stringOrderType="alphabetAsc").fit(r)
    x = OneHotEncoder(inputCols=["gi"], outputCols=["go"], dropLast=True).fit(si.transform(r))
    d = VectorAssembler(inputCols=["go", "size"], outputCol="fv").transform(x.transform(si.transform(r)))
    m = LinearRegression(featuresCol="fv", labelCol="rating").fit(d)
    names = [f"genre_{g}" for g in si.labels[:-1]] + ["size", "(intercept)"]
    vals = list(m.coefficients.toArray()) + [m.intercept]
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "term string, estimate double")


QUERIES = {
    "wald_two_prop": q_wald_two_prop,
    "soft_threshold": q_soft_threshold,
    "elastic_net": q_elastic_net,
    "reg_path": q_reg_path,
    "reg_path_select": q_reg_path_select,
    "logit_fit": q_logit_fit,
    "logit_eval": q_logit_eval,
    "scenario_score": q_scenario_score,
    "rating_regression": q_rating_regression,
}

_PHI = """CASE WHEN t >= 0 THEN 1 - (exp(-t * t / 2) / sqrt(2 * pi()) * (q * (0.319381530 + q * (-0.356563782 + q * (1.781477937
  + q * (-1.821255978 + q * 1.330274429)))))) ELSE NULL END"""

ORACLE = {
    "wald_two_prop": f"""WITH c AS (SELECT l_returnflag, l_linenumber, count(*) AS n, count(*) FILTER (WHERE l_discount >= 0.05) AS k
  FROM lineitem GROUP BY 1, 2),
j AS (SELECT a.l_linenumber, a.n AS n1, a.k AS k1, r.n AS n2, r.k AS k2, a.k / a.n AS p1, r.k / r.n AS p2
  FROM c a JOIN c r ON a.l_linenumber = r.l_linenumber AND a.l_returnflag = 'A' AND r.l_returnflag = 'R'),
z AS (SELECT *, CASE WHEN sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) > 0
  THEN (p1 - p2) / sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) END AS z FROM j),
t AS (SELECT *, abs(z) AS t, 1 / (1 + 0.2316419 * abs(z)) AS q FROM z)
SELECT l_linenumber, n1, k1, n2, k2, round(p1, 6) AS p1, round(p2, 6) AS p2, round(z, 6) AS z,
  round(2 * (1 - ({_PHI})), 6) AS p_value FROM t""",
    "soft_threshold": """SELECT l_partkey, round(b, 9) + 0.0 AS b,
  round(CASE WHEN abs(b) <= 0.1 THEN 0.0 ELSE sign(b) * (abs(b) - 0.1) / (1 + 2 * 0.2) END, 9) + 0.0 AS st
FROM (SELECT l_partkey, avg(l_discount * 10) - 0.45 AS b FROM lineitem GROUP BY l_partkey)""",
}
