"""Rank selection, splits by a cut, and permuted timetables against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orrery.operators import rank_select as rs
from orrery.operators import relational as rel
from orrery.operators import split as sp
from orrery.operators import timetable as tt


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_rows_at_equal_sorting(spark, monkeypatch, accuracy):
    """Hot values, ties, a null group, empty groups; brackets much wider than a row at accuracy 20."""
    monkeypatch.setattr(rs, "ACCURACY", accuracy)
    rnd = random.Random(accuracy)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice([0.0, 0.0, float(rnd.randrange(50)), -1.5]), rnd.randrange(6)) for _ in range(900)]
    rows += [("null values", None, 1)]
    at = [(f"t{p}", p / 10, F.floor(F.col("n") * p / 10)) for p in range(0, 11, 2)]
    got = rs.rows_at(spark.createDataFrame(rows, "g string, v double, k int"), "v", ["v", "k"], at, ["g"]).collect()
    want = set()
    for g in (None, "a", "b"):
        mine = sorted((v, k) for x, v, k in rows if x == g)
        want |= {(g, f"t{p}", len(mine), *mine[len(mine) * p // 10]) for p in range(0, 10, 2)}
    assert {(r.g, r.tag, r.n, r.v, r.k) for r in got} == want and len(got) == len(want)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(500)], "v double")
    at = [("wrong", 0.9, F.lit(17)), ("right", 0.5, F.lit(250))]  # the sketch is asked for another rank
    assert {(r.tag, r.v) for r in rs.rows_at(df, "v", ["v"], at).collect()} == {("wrong", 17.0), ("right", 250.0)}
    assert rs.rows_at(df.limit(0), "v", ["v"], at).count() == 0


def test_slices_equal_sorting(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, i long")
    key = lambda r: tuple((x is not None, x if x is not None else 0) if j != 1 else (x is not None, x or "") for j, x in enumerate(r))
    ordered = sorted(rows, key=key)
    for start, stop in ((0, 5), (30, 120), (190, 500), (200, 210), (7, 7)):
        got = rel.row_slice(df, ["a", "b", "i"], start, stop).collect()
        assert [(r.row_pos, (r.a, r.b, r.i)) for r in sorted(got, key=lambda r: r.row_pos)] == list(enumerate(ordered))[start:stop]
    by_text = rel.row_slice(df.filter("b is not null"), ["b", "i"], 3, 9).orderBy("row_pos").collect()
    assert [(r.b, r.i) for r in by_text] == sorted((b, i) for _, b, i in rows if b)[3:9]


def test_quantiles_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0, None, float(i % 3)) for i in range(40)], "a double, b double, c double")
    got = {(r.column_name, r.prob): r.value for r in rel.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.3, 1.0]).collect()}
    assert got == {("a", p): 5.0 for p in (0.0, 0.3, 1.0)} | {("c", p): float(np.quantile([i % 3 for i in range(40)], p)) for p in (0.0, 0.3, 1.0)}
    assert {r.column_name: r["count"] for r in rel.describe_exact(df, ["a", "b", "c"]).collect()} == {"a": 40, "c": 40}


def test_splits_by_a_cut(spark):
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(101)]
    df = spark.createDataFrame(rows, "id long, y int")
    order = lambda ids: sorted(ids, key=lambda i: (hashlib.md5(f"42{i}".encode()).hexdigest(), i))
    got = {r.id for r in sp.holdout(df, "id", 0.8).filter("split = 'train'").collect()}
    assert got == set(order(range(101))[:80])
    by = sp.stratified(df, "id", "y", 0.7).collect()
    for y in (None, 0, 1):
        mine = order([i for i, x in rows if x == y])
        assert {r.id for r in by if r.y == y and r.split == "train"} == set(mine[:int(len(mine) * 0.7)])
    assert len(by) == 101 and sp.holdout(df.limit(0), "id").count() == 0 and sp.holdout(df.limit(1), "id").first().split == "test"


def test_permutations_scored_as_grids(spark):
    rnd = random.Random(2)
    cells = [(r, s, rnd.choice(["*", "*", "7", "8"])) for r in range(30) for s in range(tt.N_SLOTS)]
    g = spark.createDataFrame(cells, "room int, slot int, content string")
    moves = tt.slot_permutations(spark, 12)
    seen = {}
    for r in moves.collect():
        seen.setdefault(r.candidate, {})[r.slot] = r.new_slot
    assert set(seen) == set(range(-1, 12)) and all(sorted(m.values()) == list(range(25)) for m in seen.values()) and seen[-1] == {s: s for s in range(25)}
    steps = [{(m[s + 1] - m[s]) % 25 for s in range(24)} for c, m in seen.items() if c >= 0]
    assert all(len(x) > 2 for x in steps)  # no shifts by a multiplier
    got = {r.candidate: (r.adjacent_pairs, r.free_afternoons, round(r.score, 9)) for r in tt.candidate_scores(g, moves).collect()}
    for c, m in seen.items():
        one = tt.permuted_grid(g, moves, spark.createDataFrame([(c,)], "candidate int"))
        want = tt.soft_terms(one).first()
        assert got[c] == (want.adjacent_pairs, want.free_afternoons, round(want.score, 9))


def test_no_whole_row_is_checkpointed(spark, monkeypatch):
    written = []
    from orrery.operators import split as split_module

    for module in (rs, split_module):
        monkeypatch.setattr(module, "cut_lineage", lambda df, seen=written, cut=module.cut_lineage: seen.append(df.columns) or cut(df))
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert sp.stratified(e, "vec_id", "label").count() == e.count() and sp.holdout(e, "vec_id").count() == e.count()
    assert written and not any("embedding" in c for c in written)
