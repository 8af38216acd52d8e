"""Randomised properties of the distributed building blocks (few examples: each
example runs Spark jobs)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery.operators import relational as rel
from orrery.operators import skew

values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-100, 100, allow_nan=False)),
                  min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, probs=st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=3,
                                   unique=True))
def test_exact_quantiles_random(spark, vals, probs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r.prob: r.value for r in rel.exact_quantiles(df, ["v"], probs).collect()}
    clean = np.array([v for v in vals if v is not None])
    if len(clean) == 0:
        assert got == {}
        return
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(clean, p))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3)), min_size=1, max_size=80),
       parts=st.integers(1, 7))
def test_running_total_and_rank_random(spark, rows, parts):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g int, v long")
    w = Window.partitionBy("g").orderBy("v", "id")
    want = {r.id: (r.c, r.n) for r in df.withColumn("c", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                                           .withColumn("n", F.row_number().over(w)).collect()}
    c = skew.running_total(df, ["v", "id"], "v", partition=["g"], out="c", num_partitions=parts)
    n = skew.ranked(df, ["v", "id"], partition=["g"], out="n", num_partitions=parts)
    got_c = {r.id: r.c for r in c.collect()}
    got_n = {r.id: r.n for r in n.collect()}
    assert {k: (got_c[k], got_n[k]) for k in want} == want
