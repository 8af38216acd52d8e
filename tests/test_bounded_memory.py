"""Steps whose tasks hold a bounded part of the job, whatever its size."""

import numpy as np
import pytest
from test_neighbors import brute, clusters, found, frames

from orrery.operators import classify as cl
from orrery.operators import recommend as rc
from orrery.operators import timetable as tt


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_neighbours_in_small_pieces(spark, monkeypatch, metric):
    monkeypatch.setattr(cl, "HELD", 64)
    monkeypatch.setattr(cl, "SENT", 5)
    x = np.round(clusters(np.random.default_rng(8), 120, 4, 5), 1)
    rows = [(i, str(i % 4), x[i]) for i in range(120)]
    df = frames(spark, rows)
    assert found(cl.knn_neighbors(df, df, "id", "y", "v", 6, metric=metric, exclude="g", cells=9)) == brute(rows, rows, 6, metric == "l1", True)


def test_tasks_of_conflicts_grow_with_the_pairs(spark, monkeypatch):
    rows = [(s, c) for s in range(30) for c in range(s % 7)] + [(None, c) for c in range(500)] + [(3, None)]
    e = spark.createDataFrame(rows, "student long, course long").distinct()
    monkeypatch.setattr(tt, "PAIRS", 20)
    want = {(a, b) for s in range(30) for a in range(s % 7) for b in range(s % 7) if a != b}
    edges = tt.conflict_edges(e)
    assert sorted(tuple(r) for r in edges.collect()) == sorted(want)
    tasks = tt.pair_tasks(e)
    assert 5 < tasks < 12  # 143 pairs and those with a null course; null students have none
    one, many = (sorted(tuple(r) for r in tt.conflict_bitmaps(edges, t).collect()) for t in (None, tasks))
    assert one == many
    plan = tt.conflict_bitmaps(edges, tasks)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("bitmap_construct_agg") < plan.index("Exchange")  # edges are shuffled, bitmaps aren't
    after = plan[plan.index("Exchange"):]
    assert "bitmap_construct_agg" not in after


@pytest.mark.parametrize("groups, salt", [(1, 10_000), (3, 10_000), (8, 4)])
def test_item_cosine_by_groups_of_items(spark, groups, salt):
    rnd = np.random.default_rng(4)
    rows = [(u, i, float(rnd.integers(0, 9))) for u in range(12) for i in range(14) if rnd.random() < 0.6]
    rows += [(0, 90, 2.0), (0, 90, 3.0), (None, 1, 5.0), (1, None, 5.0), (2, 91, None), (3, 91, 4.0)]
    got = {(r.item_a, r.item_b): r.cosine for r in rc.item_cosine(spark.createDataFrame(rows, "user long, item long, rating double"), salt, groups).collect()}
    norm = {i: sum((r or 0) ** 2 for _, j, r in rows if i == j) ** 0.5 for i in {j for _, j, _ in rows}}
    want = {}
    for u, a, x in rows:
        for v, b, y in rows:
            if u is not None and u == v and None not in (a, b) and a < b and norm[a] and norm[b]:
                p = want.setdefault((a, b), [])
                if x is not None and y is not None:
                    p.append(x * y / norm[a] / norm[b])
    want = {k: sum(p) if p else None for k, p in want.items()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9) if v is not None else got[k] is None
