"""Exact nearest neighbours with pruning against brute force."""

import numpy as np
import pytest

from orrery.operators import classify as cl


def brute(train, test, k, l1, exclude=False):
    out = {}
    for i, gi, x in test:
        d = sorted(((np.abs(x - y).sum() if l1 else np.sqrt(((x - y) ** 2).sum())), j) for j, gj, y in train if not (exclude and gi == gj))
        out[i] = [(j, round(float(v), 9)) for v, j in d[:k]]
    return out


def frames(spark, rows):
    return spark.createDataFrame([(i, int(i) % 3, g, [float(v) for v in x]) for i, g, x in rows], "id long, y long, g string, v array<double>")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.test_id, r.nb_rank)):
        out.setdefault(r.test_id, []).append((r.nb_id, round(r.dist, 9)))
        assert r.nb_label == r.nb_id % 3
    return out


def clusters(rnd, n, width, centres):
    """Rows around few far centres, a third of them the same point."""
    at = rnd.normal(size=(centres, width)) * 20
    x = at[rnd.integers(centres, size=n)] + rnd.normal(size=(n, width))
    x[: n // 3] = at[0]
    return x


@pytest.mark.parametrize("metric, block, cells", [("l2", 2048, None), ("l1", 16, 9), ("l2", 7, 1), ("l1", 64, 200)])
def test_equals_brute_force(spark, metric, block, cells):
    rnd = np.random.default_rng(len(metric) + block)
    x = np.round(clusters(rnd, 240, 5, 6), 1)  # coarse values: many equal distances
    train = [(i, str(i % 4), x[i]) for i in range(180)]
    test = [(i, str(i % 4), x[i]) for i in range(150, 240)]
    got = found(cl.knn_neighbors(frames(spark, train), frames(spark, test), "id", "y", "v", 7, metric=metric, block=block, cells=cells))
    want = brute(train, test, 7, metric == "l1")
    assert {i: [d for _, d in v] for i, v in got.items()} == {i: [d for _, d in v] for i, v in want.items()}
    assert got == want


def test_excluded_rows_are_no_neighbours(spark):
    x = clusters(np.random.default_rng(5), 120, 4, 5)
    rows = [(i, str(i % 5), x[i]) for i in range(120)]
    df = frames(spark, rows)
    assert found(cl.knn_neighbors(df, df, "id", "y", "v", 5, exclude="g")) == brute(rows, rows, 5, False, True)


def test_fewer_train_rows_than_k_and_odd_rows(spark):
    df = spark.createDataFrame([(1, 1, [0.0, 0.0]), (2, 2, [3.0, 4.0]), (3, 0, [float("nan"), 0.0]), (4, 1, None), (5, 2, [None, 1.0])],
                               "id long, y long, v array<double>")
    assert found(cl.knn_neighbors(df, df.filter("id in (1, 3, 4, 5)"), "id", "y", "v", 9)) == {1: [(1, 0.0), (2, 5.0)]}
    assert cl.knn_neighbors(df.filter("id = 4"), df, "id", "y", "v", 3).count() == 0 == cl.knn_neighbors(df, df.filter("id = 0"), "id", "y", "v", 3).count()


@pytest.mark.parametrize("l1", [False, True])
def test_bounds_hold_and_prune(l1):
    rnd = np.random.default_rng(3)
    x, q = clusters(rnd, 4000, 16, 30), clusters(rnd, 300, 16, 30)
    q = x[rnd.integers(4000, size=300)] + 0.1 * q / np.abs(q).max()
    cells = cl._Cells(x[rnd.choice(4000, 63, replace=False)], l1)
    d = cells.distances(x)
    cell, near = d.argmin(axis=1), d.min(axis=1)
    some = [near[cell == c] for c in range(63)]
    cells.rows = np.array([len(s) for s in some])
    cells.least = np.array([s.min() if len(s) else np.inf for s in some])
    cells.most = np.array([s.max() if len(s) else -np.inf for s in some])
    true = cl._distances(q, x, l1) if l1 else np.sqrt(cl._distances(q, x, l1))
    bound = cells.least_distance(cells.distances(q), np.abs(q).max(axis=1) * 16)
    for c in np.flatnonzero(cells.rows):
        assert (bound[:, c] <= true[:, cell == c].min(axis=1)).all()
    limit = np.sort(true, axis=1)[:, 4]
    home = cells.home(cells.distances(q), 20)
    assert (home.sum(axis=1) >= 1).all()
    visited = (home | ((bound <= limit[:, None]) & (cells.rows > 0))).sum()
    assert visited < 0.25 * len(q) * (cells.rows > 0).sum()


def test_class_scatter_of_wide_vectors(spark):
    from orrery.operators import models as md

    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(600, 90)) * rnd.uniform(0.1, 3, size=90) + 1e6
    y = rnd.integers(3, size=600)
    rows = [(int(c), [float(v) for v in r]) for c, r in zip(y, x)] + [(None, [0.0] * 90), (1, None), (1, [None] * 90)]
    got = {r.label: r for r in md.class_scatter(spark.createDataFrame(rows, "y int, v array<double>").repartition(7), "y", "v").collect()}
    assert sorted(got) == [0.0, 1.0, 2.0]
    for c in range(3):
        mine = x[y == c]
        assert got[c].n == len(mine) and np.allclose(got[c].mean, mine.mean(axis=0), rtol=1e-14)
        assert np.allclose(np.array(got[c].scatter).reshape(90, 90) / (len(mine) - 1), np.cov(mine.T), atol=1e-8)
    assert md.class_scatter(spark.createDataFrame([], "y int, v array<double>"), "y", "v").count() == 0


def test_a_row_is_sent_once_to_a_group_of_cells(spark, monkeypatch):
    x = np.random.default_rng(8).normal(size=(300, 24))  # spread out: the bounds exclude next to nothing
    rows = [(i, str(i % 5), x[i]) for i in range(300)]
    sent, cut = [], cl.cut_lineage

    def counted(df, *a, **k):
        if "cell" in df.columns and "_y" not in df.columns:
            sent.append(df.count())
        return cut(df, *a, **k)

    monkeypatch.setattr(cl, "cut_lineage", counted)
    df = frames(spark, rows)
    assert found(cl.knn_neighbors(df, df, "id", "y", "v", 4, metric="l1", exclude="g", block=100, cells=30)) == brute(rows, rows, 4, True, True)
    assert len(sent) == 2 and 300 <= sum(sent) <= 300 * 4


@pytest.mark.parametrize("l1", [False, True])
def test_quick_distances_stay_within_their_rounding(l1):
    rnd = np.random.default_rng(6)
    for scale, shift in ((1.0, 0.0), (1e-6, 1e3), (1e8, 0.0), (1e20, 0.0)):
        a, b = rnd.normal(size=(70, 33)) * scale + shift, rnd.normal(size=(1500, 33)) * scale + shift
        quick, slack, share = cl._near_distances(a, b, l1)
        true = cl._distances(a, b, l1)
        assert (np.abs(quick - true) <= slack + share * true).all()
        r, c = rnd.integers(70, size=50), rnd.integers(1500, size=50)
        assert (cl._pair_distances(a[r], b[c], l1) == true[r, c]).all()
    assert [list(range(*p)) for p in cl._cuts(np.array([0, 0, 0, 1, 1, 2, 3]), 2)] == [[0, 1, 2], [3, 4], [5, 6]]
