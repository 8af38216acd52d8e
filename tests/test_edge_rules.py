"""Null groups, hot keys, zero divisors, large means, singular classes, micro-batches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orrery.functions.columns import dense_cosine
from orrery.operators import classify as cl
from orrery.operators import metrics as mt
from orrery.operators import models as md
from orrery.operators import recommend as rc
from orrery.operators import regress as rg
from orrery.operators import skew
from orrery.operators import split as sp
from orrery.operators import timeseries as ts
from orrery.operators import timetable as tt


def test_ranked_and_running_total_keep_null_groups(spark):
    data = [(i, None if i % 4 == 0 else i % 3, (i * 7) % 11) for i in range(400)]
    df = spark.createDataFrame(data, "id long, g int, v long")
    ranks = {(r.g, r.id): r.k for r in skew.ranked(df, ["id"], partition=["g"], out="k", num_partitions=5).collect()}
    sums = {(r.g, r.id): r.c for r in skew.running_total(df, ["id"], "v", partition=["g"], out="c", num_partitions=5).collect()}
    for g in (None, 0, 1, 2):
        mine = [(i, v) for i, x, v in data if x == g]
        assert [ranks[g, i] for i, _ in mine] == list(range(1, len(mine) + 1))
        assert [sums[g, i] for i, _ in mine] == list(np.cumsum([v for _, v in mine]))
    assert len(ranks) == len(sums) == 400


def test_running_total_keeps_decimals(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "id long").withColumn("v", F.lit("0.10").cast("decimal(10,2)"))
    got = skew.running_total(df, ["id"], "v", num_partitions=3)
    assert dict(got.dtypes)["cum"].startswith("decimal") and str(got.agg(F.max("cum")).first()[0]) == "2.00"


def test_stratified_keeps_null_class(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(30)], "id long, y int")
    got = sp.stratified(df, "id", "y").collect()
    assert len(got) == 30 and sum(r.y is None and r.split == "train" for r in got) == 8


def test_lags_with_null_series(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i, float(i)) for i in range(60)], "s string, d int, v double")
    got = ts.lag_features(df, "s", "d", "v", 10).collect()
    assert len(got) == 40 and sum(r.s is None for r in got) == 20


def test_last_value_of_a_day(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP'2020-01-01 01:00:00', 9.0D), ('a', TIMESTAMP'2020-01-01 02:00:00', 1.0D) AS t(s, ts, v)")
    assert ts.series_daily(df, "s", "ts", "v", how="last").first().close == 1.0


def test_hot_keys_are_split_by_size(spark):
    rnd = random.Random(1)
    rows = {(1 if rnd.random() < 0.4 else rnd.randrange(40), rnd.randrange(60)) for _ in range(500)}
    df = spark.createDataFrame(sorted(rows), "student long, course long")
    left, right = skew.salted_self_join(df, df, "student", "course", threshold=10)
    assert left.filter("student = 1").select("_salt").distinct().count() > 2
    want = {(a, b) for s, a in rows for t, b in rows if s == t and a != b}
    assert {tuple(r) for r in tt.conflict_edges(df, salt_threshold=10).collect()} == want


def test_conflicts_in_a_slot_equal_plain_pairs(spark):
    rnd = random.Random(6)
    enrol = {(1 if rnd.random() < 0.4 else rnd.randrange(30), rnd.randrange(40)) for _ in range(300)}
    assign = [(c, k, rnd.randrange(8)) for c in range(40) for k in (0, 1)]
    want = {(a, k, b, m, x) for s, a in enrol for t, b in enrol if s == t and a < b for c, k, x in assign if c == a for d, m, y in assign if d == b and x == y}
    got = tt.conflict_violations(spark.createDataFrame(sorted(enrol), "student long, course long"),
                                 spark.createDataFrame(assign, "course long, lesson int, slot int"), salt_threshold=5).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 50


def test_bitmaps_hold_the_edges(spark):
    edges = [(1, 0), (1, 7), (1, 8), (1, 32767), (1, 32768), (2, 100_000), (2, 100_001)]
    maps = tt.conflict_bitmaps(spark.createDataFrame(edges, "course_a long, course_b long"))
    assert {(r.course, r.bucket): r.n_conflicts for r in maps.collect()} == {(1, 1): 4, (1, 2): 1, (2, 4): 2}
    assert sorted(map(tuple, tt.bitmap_members(maps).collect())) == edges


def test_weights_of_a_null_class(spark):
    got = cl.balanced_weights(spark.createDataFrame([(1, None), (2, 0), (3, 0), (4, 0)], "id long, y int"), "y").collect()
    assert {r.id: round(r.weight, 6) for r in got} == {1: 2.0, 2: 0.666667, 3: 0.666667, 4: 0.666667}


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    points = mt.roc_points(df, "y", "p")
    assert [r.fpr for r in points.collect()] == [None, None] and mt.roc_auc(points).first().auc is None
    three = spark.createDataFrame([(0, 0.9, 0.1, 0.0), (1, 0.3, 0.7, 0.0)], "y int, p0 double, p1 double, p2 double")
    got = mt.classification_summary(three.withColumn("pred", F.col("y")), "y", "pred", {0: "p0", 1: "p1", 2: "p2"}).first()
    assert got.weighted_auc == 1.0 and got.accuracy == 1.0


def test_zero_divisors(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0], 0, 0, 5, 2)], "a array<float>, b array<float>, n1 int, k1 int, n2 int, k2 int")
    assert df.select(dense_cosine(F.col("a"), F.col("b")).alias("c")).first().c is None
    w = rg.wald_two_prop(df, "n1", "k1", "n2", "k2").first()
    assert (w.p1, w.z, w.p_value) == (None, None, None)
    r = spark.createDataFrame([(1, 1, 0.0), (1, 2, 3.0), (2, 2, 4.0), (1, 3, 1.0)], "user long, item long, rating double")
    assert [(x.item_a, x.item_b) for x in rc.item_cosine(r).collect()] == [(2, 3)]


def test_dense_cosine_squares_in_double(spark):
    x = [16777217.0 / 3, 1e-3]
    df = spark.createDataFrame([(x, [1.0, 1.0])], "a array<float>, b array<float>")
    a = np.float32(x).astype(float)
    want = a.sum() / (np.sqrt((a * a).sum()) * np.sqrt(2))
    assert df.select(dense_cosine(F.col("a"), F.col("b")).alias("c")).first().c == pytest.approx(want, rel=1e-15)


def test_distance_vote_with_an_equal_row(spark):
    n = spark.createDataFrame([(1, 7, 0.0), (1, 3, 0.1), (1, 3, 0.1), (2, 5, 0.5), (2, 4, 0.1)], "test_id long, nb_label long, dist double")
    assert {r.test_id: r.pred for r in cl.knn_vote(n, weighted=True).collect()} == {1: 7, 2: 4}


def test_moments_survive_large_means(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=5000)
    df = spark.createDataFrame([(float(1e9 + v), float(2 * v), i % 2) for i, v in enumerate(x)], "x double, y double, g int")
    for r in rg.gram_stats(df, "y", ["x"], ["g"]).collect():
        s, mine = rg.Suff(r.asDict(), 1), x[r["g"]::2]
        assert s.scatter[0, 0] / s.n == pytest.approx(mine.var(), rel=1e-5)
        zz, zv, vv, n = rg.centred(s, *rg.standardiser(s))
        assert zz[0, 0] / n == pytest.approx(1) and zv[0] / n == pytest.approx(1, rel=1e-5)


def test_qda_with_a_constant_feature(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, i % 2, float(rnd.normal(3 * (i % 2))), 1.0 if i % 2 else float(rnd.normal())) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y long, a double, b double")
    got = md.predict_discriminant(md.fit_discriminant(df, "y", ["a", "b"], quadratic=True), df, "id", ["a", "b"]).collect()
    assert np.mean([r.pred == r.id % 2 for r in got]) > 0.85


def test_streams_do_not_depend_on_batches(spark, tmp_path):
    from orrery.plans import streaming

    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    assert streaming.q_stream_ingest(spark, str(tmp_path)).count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    for query in (streaming.q_stream_forecast, streaming.q_stream_series):
        one = sorted(map(tuple, query(spark, SF_SMALL).collect()), key=str)
        many = sorted(map(tuple, query(spark, str(tmp_path), max_files=1).collect()), key=str)
        assert one == many and len(one) > 0


def test_stream_forecast_equals_its_batch_twin(spark):
    from orrery.plans import streaming
    from orrery.streaming import hops

    daily = ts.series_daily(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "event_type", "ts", "value")
    want = {r.event_type: (r.date, r.prev_date, round(r.close, 6), round(r.prediction, 6)) for r in hops.forecast_series(daily).collect()}
    got = {r.event_type: (r.date, r.prev_date, r.close, r.prediction) for r in streaming.q_stream_forecast(spark, SF_SMALL).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) if isinstance(got[k], float) else got[k][:2] == want[k][:2] for k in got)
    assert all(got[k][3] == pytest.approx(want[k][3], abs=1e-5) for k in got)
