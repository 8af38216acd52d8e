"""Model operators against NumPy brute force and closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from orrery.operators import classify as cl
from orrery.operators import models as md
from orrery.operators import regress as rg
from orrery.plans.ml_common import FEATS, with_holdout


@pytest.fixture(scope="module")
def parts(spark):
    h = with_holdout(spark, SF_SMALL).toPandas()
    return h[h.split == "train"], h[h.split == "test"]


def test_knn_brute_force(spark, parts):
    tr, te = parts
    got = E.queries()["knn_vote"](spark, SF_SMALL).toPandas().set_index("vec_id").pred
    xt, xr = te[FEATS].to_numpy(), tr[FEATS].to_numpy()
    d = ((xt[:, None, :] - xr[None, :, :]) ** 2).sum(-1)
    for i, vid in enumerate(te.vec_id):
        order = np.lexsort((tr.vec_id.to_numpy(), d[i]))[:5]
        labs, cnt = np.unique(tr.label.to_numpy()[order], return_counts=True)
        assert got[vid] == labs[np.argmax(cnt)]


def test_knn_blocks_do_not_change_result(spark, parts):
    h = with_holdout(spark, SF_SMALL)
    tr, te = h.filter(F.col("split") == "train"), h.filter(F.col("split") == "test")
    one = cl.knn_vote(cl.knn_neighbors(tr, te, "vec_id", "label", FEATS, 5))
    many = cl.knn_vote(cl.knn_neighbors(tr, te, "vec_id", "label", FEATS, 5, block=16))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_naive_bayes_numpy(spark, parts):
    tr, te = parts
    got = E.queries()["clf_nb"](spark, SF_SMALL).toPandas().set_index("vec_id").pred
    x, y = tr[FEATS].to_numpy(), tr.label.to_numpy()
    cls = np.unique(y)
    eps = 1e-9 * x.var(axis=0).max()
    mu = np.array([x[y == c].mean(0) for c in cls])
    var = np.array([x[y == c].var(0) for c in cls]) + eps
    lp = np.log(np.array([(y == c).mean() for c in cls]))
    xt = te[FEATS].to_numpy()
    jll = lp - 0.5 * np.log(2 * np.pi * var).sum(1) - 0.5 * (((xt[:, None, :] - mu) ** 2) / var).sum(2)
    want = cls[np.argmax(jll, 1)]
    assert (got.loc[te.vec_id].to_numpy() == want).all()


@pytest.mark.parametrize("quadratic", [False, True])
def test_discriminant_numpy(spark, parts, quadratic):
    tr, te = parts
    key = "clf_qda" if quadratic else "clf_lda"
    got = E.queries()[key](spark, SF_SMALL).toPandas().set_index("vec_id").pred
    x, y = tr[FEATS].to_numpy(), tr.label.to_numpy()
    cls = np.unique(y)
    mu = np.array([x[y == c].mean(0) for c in cls])
    lp = np.log(np.array([(y == c).mean() for c in cls]))
    xt = te[FEATS].to_numpy()
    pooled = sum(((x[y == c] - mu[k]).T @ (x[y == c] - mu[k])) for k, c in enumerate(cls)) / (len(x) - len(cls))
    if quadratic:
        s = []
        for k, c in enumerate(cls):
            cov = np.cov(x[y == c].T)
            if np.linalg.matrix_rank(cov, hermitian=True) < x.shape[1]:  # fewer rows than features: the pooled one
                cov = pooled
            pr = np.linalg.pinv(cov)
            dlt = xt - mu[k]
            s.append(-0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", dlt, pr, dlt) + lp[k])
        s = np.stack(s, 1)
    else:
        pr = np.linalg.pinv(pooled)
        s = xt @ (mu @ pr).T - 0.5 * np.einsum("kj,kj->k", mu @ pr, mu) + lp
    want = cls[np.argmax(s, 1)]
    assert (got.loc[te.vec_id].to_numpy() == want).mean() > 0.97  # near-ties may flip


def _cd_rows(x, y, l1, l2, iters=100, tol=1e-6):
    n, p = x.shape
    b = np.zeros(p)
    for _ in range(iters):
        prev = b.copy()
        for j in range(p):
            rho = np.mean(b[j] + x[:, j] * (y - x @ b))
            b[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (1 + 2 * l2)
        if np.max(np.abs(b - prev)) < tol:
            break
    return b


def test_elastic_net_gram_equals_row_descent(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = x @ np.array([1.0, -0.5, 0.0, 0.25, 2.0]) + rng.normal(scale=0.5, size=400)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)],
                               "a double, b double, c double, d double, e double, y double")
    got = rg.elastic_net(df, "y", list("abcde"), 0.2, 0.2).toPandas()
    last = got[got.sweep == got.sweep.max()].set_index("feature").beta
    xs = (x - x.mean(0)) / x.std(0)
    ys = (y - y.mean()) / y.std()
    want = _cd_rows(xs, ys, 0.2, 0.2)
    assert np.allclose(last.loc[list("abcde")].to_numpy(), want, atol=1e-6)


def test_elastic_net_matches_spark_mapping(spark):
    """regParam = l1 + 2 l2 s_y, elasticNetParam = l1 / regParam on standardised
    data with population std (normal solver) reaches the same fixed point."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = x @ np.array([0.8, -0.3, 0.0, 0.5]) + rng.normal(scale=0.7, size=300)
    xs = (x - x.mean(0)) / x.std(0)
    ys = (y - y.mean()) / y.std()
    l1, l2 = 0.1, 0.2
    want = _cd_rows(xs, ys, l1, l2, iters=2000, tol=1e-12)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(xs, ys)],
                               "a double, b double, c double, d double, y double")
    reg = l1 + 2 * l2 * 1.0
    lr = LinearRegression(featuresCol="f", labelCol="y", regParam=reg, elasticNetParam=l1 / reg,
                          fitIntercept=False, standardization=False, solver="normal", tol=1e-12, maxIter=1000)
    m = lr.fit(VectorAssembler(inputCols=list("abcd"), outputCol="f").transform(df))
    assert np.allclose(m.coefficients.toArray(), want, atol=1e-5)


def test_reg_path_select_picks_min_validation(spark):
    from orrery.plans.regress import L1_GRID, L2_GRID, XS, Y, regression_rows
    mse, betas = rg.reg_path(regression_rows(spark, SF_SMALL), Y, XS, "run", "set", L1_GRID[:4], L2_GRID[:3])
    m = mse.toPandas()
    best = m[m.set == "validation"].groupby(["l1", "l2"]).mse.mean().idxmin()
    sel = rg.reg_path_select(mse, betas).collect()[0]
    assert (sel.l1, sel.l2) == best


def test_reg_path_reads_its_rows_twice(spark):
    """Selecting from the path reads the rows for the means and the products, not again per result."""
    from orrery.plans.regress import L1_GRID, L2_GRID, XS, Y, regression_rows
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    rows = regression_rows(spark, SF_SMALL)
    n, rows = rows.count(), rows.mapInPandas(seen, rows.schema)
    mse, betas = rg.reg_path(rows, Y, XS, "run", "set", L1_GRID[:2], L2_GRID[:2])
    assert len(rg.reg_path_select(mse, betas).collect()) == 1
    assert 0 < read.value <= 2 * n


def test_stream_equals_batch(spark):
    got = E.queries()["stream_ingest"](spark, SF_SMALL).count()
    assert got == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_forest_prefix_error_shape(spark):
    r = E.queries()["tree_sweep"](spark, SF_SMALL).toPandas()
    assert sorted(r.k) == list(range(1, 101))
    assert r.error_rate.between(0, 1).all()


def test_pca_explained_in_unit_interval(spark):
    r = E.queries()["pca_explained"](spark, SF_SMALL).toPandas()
    assert r.explained_variance.sum() <= 1.0 + 1e-9 and (r.explained_variance > 0).all()


def test_discriminant_model_size(spark, parts):
    h = with_holdout(spark, SF_SMALL)
    m = md.fit_discriminant(h.filter(F.col("split") == "train"), "label", FEATS, quadratic=True)
    assert m["prec"].shape == (10, len(FEATS), len(FEATS))


def test_logistic_grid_equals_single_fits(spark):
    """A grid point equals the folds fitted one by one."""
    from pyspark.ml.classification import LogisticRegression
    from orrery.operators import split as spl
    h = with_holdout(spark, SF_SMALL).filter(F.col("split") == "train")
    h = md.assemble(spl.kfold(h, "vec_id", 3, 42), FEATS[:4]).withColumn("w1", F.lit(1.0)).withColumn("label", F.col("label").cast("double"))
    g = {r.strategy: r.mean_accuracy for r in md.logistic_c_grid(h, [0.5], {"none": "w1"}, "fold", 3).collect()}
    n, acc = h.count(), []
    for f in range(3):
        m = LogisticRegression(featuresCol="fv", family="multinomial", regParam=3 / (0.5 * n * 2), standardization=False, maxIter=20)
        out = m.fit(h.filter(F.col("fold") != f)).transform(h.filter(F.col("fold") == f))
        acc.append(out.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
    assert g["multinomial"] == pytest.approx(np.mean(acc), abs=0.03) and 0 <= g["ovr"] <= 1


def test_stream_restart_is_idempotent(spark):
    """Re-running a file-sink stream with the same checkpoint writes nothing twice."""
    from orrery.plans.streaming import event_stream
    from orrery.sources.files import scratch_path
    from orrery.streaming import hops
    sink, ck = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    hops.run_to_sink(hops.ingest(event_stream(spark, SF_SMALL)), sink, checkpoint=ck)
    first = spark.read.parquet(sink).count()
    hops.run_to_sink(hops.ingest(event_stream(spark, SF_SMALL)), sink, checkpoint=ck)
    assert spark.read.parquet(sink).count() == first == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_item_cosine_salted_equals_plain(spark):
    from orrery.operators import recommend as rc
    from orrery.plans.recommend import supplier_ratings
    r = supplier_ratings(spark, SF_SMALL)
    plain = {(a, b): round(c, 9) for a, b, c in rc.item_cosine(r).collect()}
    salted = {(a, b): round(c, 9) for a, b, c in rc.item_cosine(r, salt_threshold=2).collect()}
    assert plain == salted
    assert len(plain) == 45  # 10 suppliers at sf0.001, every pair co-rated


def test_gbt_prefix_error_matches_model(spark):
    """After all iterations the prefix-margin error equals the model's own error."""
    from pyspark.ml.classification import GBTClassifier
    from orrery.plans.models import parts as mparts
    train, test = mparts(spark, SF_SMALL)
    binar = lambda df: df.withColumn("label", (F.col("label") >= 5).cast("double"))
    m = GBTClassifier(featuresCol="fv", labelCol="label", maxIter=8, seed=42).fit(binar(train))
    err = {r.k: r.error_rate for r in md.gbt_prefix_error(m, binar(test), "vec_id").collect()}
    p = m.transform(binar(test)).select(F.avg((F.col("prediction") != F.col("label")).cast("double"))).first()[0]
    assert sorted(err) == list(range(1, 9)) and err[8] == pytest.approx(p)


def test_forest_prefix_full_equals_forest(spark):
    """With all trees, the prefix prediction is the forest's own prediction."""
    from orrery.plans.models import forest
    m, test = forest(spark, SF_SMALL, 15)
    err = {r.k: r.error_rate for r in md.forest_prefix_error(m, test, "vec_id").collect()}
    p = m.transform(test).select(F.avg((F.col("prediction") != F.col("label")).cast("double"))).first()[0]
    assert sorted(err) == list(range(1, 16)) and err[15] == pytest.approx(p)
