"""Small hand-made cases (FIXTURES.md part 3)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import metrics as mt
from orrery.operators import regress as rg
from orrery.operators import relational as rel
from orrery.operators import text as tx
from orrery.operators import timeseries as ts
from orrery.operators import timetable as tt

D0 = dt.date(2024, 1, 1)


def _series(spark, values, series="s"):
    rows = [(series, D0 + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, date date, close double")


def test_sentiment_hole(spark):
    df = spark.createDataFrame([(0.02,), (0.0,), (0.05,), (-0.05,)], "s double")
    got = df.select("s", tx.sentiment_bucket("s").alias("b"), tx.sentiment_bucket("s", strict=True).alias("st"))
    r = {x.s: (x.b, x.st) for x in got.collect()}
    assert r[0.02] == ("neutral", None)
    assert r[0.0] == ("neutral", "neutral")
    assert r[0.05] == ("positive", "positive")
    assert r[-0.05] == ("negative", "negative")


def test_incomplete_window_dropped(spark):
    vals = [float(i) for i in range(12)]
    vals[5] = None
    lf = ts.lag_features(_series(spark, vals), "series", "date", "close", 10)
    # windows ending at rows 9 and 10 contain the null; row 11 has no next label
    assert lf.count() == 0
    full = ts.lag_features(_series(spark, [float(i) for i in range(12)]), "series", "date", "close", 10)
    r = full.orderBy("date").collect()
    assert len(r) == 2 and r[0].features == [float(i) for i in range(10)] and r[0].label == 10.0


def test_streaming_layout(spark):
    lf = ts.lag_features(_series(spark, [float(i) for i in range(12)]), "series", "date", "close", 10,
                         include_current=False)
    r = lf.orderBy("date").collect()
    assert [x.label for x in r] == [10.0, 11.0] and r[0].features == [float(i) for i in range(10)]


def test_warmup(spark):
    assert ts.warmup_drop(_series(spark, [1.0] * 12), "series", "date", 10).count() == 2


def test_constant_series_scales_to_half(spark):
    s = ts.minmax_scale(_series(spark, [3.0] * 5), "series", "close", out="x")
    assert {r.x for r in s.collect()} == {0.5}


def test_split_threshold_day_in_train(spark):
    s = ts.time_split(_series(spark, [1.0] * 40), "series", "date", 30).collect()
    thr = max(r.date for r in s) - dt.timedelta(days=30)
    assert [r.split for r in s if r.date == thr] == ["train"]
    assert sum(r.split == "test" for r in s) == 30


def test_direction(spark):
    df = spark.createDataFrame([(1.0,), (-2.0,), (0.0,)], "c double")
    assert [r.d for r in df.select(ts.direction_label(F.col("c")).alias("d")).collect()] == ["rises", "falls", "same"]


def test_auc_ties_half(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3), (0, 0.3)], "y int, score double")
    assert mt.roc_auc(mt.roc_points(df, "y", "score")).collect()[0].auc == pytest.approx(0.5)


def test_auc_matches_pairs(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300), 1)  # many ties
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    assert mt.roc_auc(mt.roc_points(df, "y", "score")).collect()[0].auc == pytest.approx(want)


def test_argmin_tie_lowest_key(spark):
    df = spark.createDataFrame([("g", 2, 1.0), ("g", 1, 1.0), ("g", 3, 5.0)], "g string, k int, v double")
    r = rel.argmin_row(df, ["g"], "v", ["k"], ["k", "v"]).collect()[0]
    assert (r.k, r.v) == (1, 1.0)


def test_expand_zero_passed(spark):
    df = spark.createDataFrame([("a", 3, 0), ("b", 2, 2)], "g string, n int, k int")
    r = rel.expand_counts(df, ["g"], "n", "k").groupBy("g", "result").count().collect()
    assert sorted((x.g, x.result, x["count"]) for x in r) == [("a", 0, 3), ("b", 1, 2)]


def test_expand_large_count_chunks(spark):
    df = spark.createDataFrame([("a", 10_000, 9_001)], "g string, n int, k int")
    r = rel.expand_counts(df, ["g"], "n", "k").groupBy("result").count().collect()
    assert sorted((x.result, x["count"]) for x in r) == [(0, 999), (1, 9001)]


def test_glm_weights_equal_expansion(spark):
    from pyspark.ml.feature import VectorAssembler
    groups = [(0.0, 0.0, 30, 12), (1.0, 0.0, 25, 15), (0.0, 1.0, 40, 10), (1.0, 1.0, 20, 14)]
    counts = spark.createDataFrame(groups, "a double, b double, n int, k int")
    expanded = rel.expand_counts(counts, ["a", "b"], "n", "k").withColumn("label", F.col("result").cast("double"))
    weighted = (counts.select("a", "b", F.lit(1.0).alias("label"), F.col("k").cast("double").alias("w"))
                .unionByName(counts.select("a", "b", F.lit(0.0).alias("label"), (F.col("n") - F.col("k")).cast("double").alias("w"))))
    va = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    m1 = rg.fit_binomial_glm(va.transform(expanded), "label")
    m2 = rg.fit_binomial_glm(va.transform(weighted), "label", weight="w")
    assert np.allclose(m1.coefficients.toArray(), m2.coefficients.toArray(), atol=1e-9)
    assert m1.intercept == pytest.approx(m2.intercept, abs=1e-9)


def test_wald_matches_closed_form(spark):
    from math import erf, sqrt
    df = spark.createDataFrame([(200, 120, 180, 90)], "n1 long, k1 long, n2 long, k2 long")
    r = rg.wald_two_prop(df, "n1", "k1", "n2", "k2").collect()[0]
    p1, p2 = 0.6, 0.5
    z = (p1 - p2) / sqrt(p1 * (1 - p1) / 200 + p2 * (1 - p2) / 180)
    assert r.z == pytest.approx(z)
    assert r.p_value == pytest.approx(2 * (1 - 0.5 * (1 + erf(abs(z) / sqrt(2)))), abs=2e-7)


def test_conflict_single_course_student(spark):
    e = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, 12)], "student long, course long")
    got = sorted(tuple(r) for r in tt.conflict_edges(e).collect())
    assert got == [(10, 11), (11, 10)]


def test_conflict_salted_equals_plain(spark):
    rows = [(1, c) for c in range(40)] + [(2, 3), (2, 50), (3, 50), (3, 51)]
    e = spark.createDataFrame(rows, "student long, course long")
    plain = sorted(tuple(r) for r in tt.conflict_edges(e, salt_threshold=1_000).collect())
    salted = sorted(tuple(r) for r in tt.conflict_edges(e, salt_threshold=5).collect())
    assert plain == salted
    assert len(plain) == 40 * 39 + 2 + 2  # (3, 50) and (50, 51) in both directions


def test_room_clash_and_precedence(spark):
    a = spark.createDataFrame([(1, 0, 3, 5), (2, 0, 3, 5), (1, 1, 4, 2), (2, 1, 1, 9)],
                              "course long, lesson int, room int, slot int")
    assert [(r.room, r.slot, r.n_lessons) for r in tt.room_overlaps(a).collect()] == [(3, 5, 2)]
    p = tt.precedence_violations(a).collect()
    assert [(r.course, r.slot, r.next_slot) for r in p] == [(1, 5, 2)]


def test_adjacency_free_slots_count(spark):
    rooms = spark.createDataFrame([(1,)], "n_rooms int")
    assign = spark.createDataFrame([(7, 0, 0, 0)], "course long, lesson int, room int, slot int")
    g = tt.grid(assign, rooms)
    s = tt.soft_terms(g).collect()[0]
    # 5 days x 4 adjacent pairs = 20 pairs; only (slot0='7', slot1='*') differs
    assert s.adjacent_pairs == 19
    assert s.free_afternoons == 10
    assert s.score == pytest.approx(19 * 0.1 + 10)


def test_soft_threshold(spark):
    df = spark.createDataFrame([(0.5,), (-0.5,), (0.05,), (-0.05,)], "b double")
    got = [r.s for r in df.select(rg.soft_threshold(F.col("b"), 0.1, 0.2).alias("s")).collect()]
    assert got == pytest.approx([0.4 / 1.4, -0.4 / 1.4, 0.0, 0.0])
