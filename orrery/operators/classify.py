"""Classifiers whose fit is a closed-form aggregation (survey M3, M16-M19, M23, M36).

Features are plain double columns. Fitting = one grouped aggregation producing a
model table of size (classes × features) or (classes × features²); scoring = a
broadcast of that model table (its size is the model's, independent of the rows)
and column arithmetic or a vectorised pandas step per partition.

Exact k-nearest-neighbours: train rows are dealt to cells around centres, and a test
row visits only the cells whose bounds allow a row within its k-th distance (see
``knn_neighbors``). Distances are computed block by block with NumPy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.recommend import class_centroids
from orrery.operators.scalar_join import attach_scalar
from orrery.session import cut_lineage

LOG_2PI = math.log(2 * math.pi)


# ---------------------------------------------------------------- scaling, weights

def fit_standard(train: DataFrame, feats: list[str]) -> DataFrame:
    """One-row model: mean and population std per feature (divide by n, as the
    usual in-memory scaler does; Spark's ML scaler divides by n-1)."""
    return train.agg(*[F.avg(c).alias(f"_mu_{c}") for c in feats],
                     *[F.stddev_pop(c).alias(f"_sd_{c}") for c in feats])


def apply_standard(df: DataFrame, model: DataFrame, feats: list[str], prefix: str = "z_") -> DataFrame:
    j = attach_scalar(df, model)
    for c in feats:
        sd = F.col(f"_sd_{c}")
        j = j.withColumn(f"{prefix}{c}", F.when(sd == 0, F.lit(0.0))
                         .otherwise((F.col(c) - F.col(f"_mu_{c}")) / sd))
    return j.drop(*[f"_mu_{c}" for c in feats], *[f"_sd_{c}" for c in feats])


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """weight = n / (n_classes * n_class): every class carries the same total weight.
    A null label is a class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    cw = attach_scalar(counts, tot).select(
        F.col(label).alias("_l"), (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(cw, F.col(label).eqNullSafe(F.col("_l"))).drop("_l")


# ---------------------------------------------------------------- k nearest neighbours

MAX_CELLS = 4096  # cells of a neighbour search: their centres and bounds are on the driver
HOME_ROWS = 4  # times k: train rows of the cells that a test row visits first
HELD = 1 << 19  # distances that a Python worker works on at once
NEAR = 1 << 16  # of them, kept in the processor's cache while they are summed
BLOCKS = 12  # blocks that the train rows are cut into, while a block has 1,024 to 16,384 rows
SENT = 4096  # visits in one batch
SLACK = 1e-6  # of the coordinates' size: rounding of distances to centres never prunes a neighbour


def _vector(feats: list[str] | str):
    """The feature vector as one column: an array column's name, or feature columns."""
    return F.col(feats).cast("array<double>") if isinstance(feats, str) else F.array(*[F.col(c).cast("double") for c in feats])


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(xa: np.ndarray, xb: np.ndarray, l1: bool) -> np.ndarray:
    """Summed feature by feature, left to right: absolute differences, or squares."""
    d = np.zeros((len(xa), len(xb)))
    for j in range(xa.shape[1]):
        diff = xa[:, j, None] - xb[None, :, j]
        d += np.abs(diff) if l1 else diff * diff
    return d


def _pair_distances(xa: np.ndarray, xb: np.ndarray, l1: bool) -> np.ndarray:
    """``_distances`` of the pairs of rows at the same place: the same sums in the same order."""
    d = np.zeros(len(xa))
    for j in range(xa.shape[1]):
        diff = xa[:, j] - xb[:, j]
        d += np.abs(diff) if l1 else diff * diff
    return d


def _cuts(rows: np.ndarray, held: int):
    """Pieces of ``rows`` (ascending) of about ``held`` that don't cut a run of equal ones."""
    lo = 0
    while lo < len(rows):
        hi = len(rows) if len(rows) - lo <= held else max(np.searchsorted(rows, rows[lo + held]), np.searchsorted(rows, rows[lo], "right"))
        yield lo, int(hi)
        lo = int(hi)


def _near_distances(xa: np.ndarray, xb: np.ndarray, l1: bool):
    """Distances as ``_distances`` gives them, but for rounding (the second result, per row of
    ``xa`` and on top of what a distance itself asks for: the third, relative), quickly: squares by
    a matrix product, absolute differences in single precision, a piece of the cache at a time."""
    width, most = xa.shape[1], max(np.abs(xa).max(initial=0.0), np.abs(xb).max(initial=0.0))
    if not most < 1e15:  # also infinite values: no shorter way
        return _distances(xa, xb, l1), 0.0, 0.0
    if not l1:
        d = (xa * xa).sum(axis=1)[:, None] + (xb * xb).sum(axis=1)[None, :]
        d -= 2 * (xa @ xb.T)
        return d, 16 * (width + 4) * np.finfo(np.float64).eps * width * most * most, 0.0
    a, b = xa.astype(np.float32), np.ascontiguousarray(xb.T, dtype=np.float32)
    d = np.zeros((len(xa), len(xb)), np.float32)
    cols = min(len(xb), 1024)
    rows = max(1, NEAR // cols)
    held = np.empty((rows, cols), np.float32)
    for i in range(0, len(xa), rows):
        for j in range(0, len(xb), cols):
            part = d[i:i + rows, j:j + cols]
            diff = held[:part.shape[0], :part.shape[1]]
            for f in range(width):
                np.subtract(a[i:i + rows, f, None], b[None, f, j:j + cols], out=diff)
                np.abs(diff, out=diff)
                part += diff
    eps = float(np.finfo(np.float32).eps)
    return d, 4 * width * eps * most + 1e-30, 2 * (width + 4) * eps


class _Cells:
    """Centres of the cells of a neighbour search; ``rows``, ``least`` and ``most`` per cell:
    its train rows and the bounds of their distances to the centre."""

    def __init__(self, centres: np.ndarray, l1: bool):
        self.centres, self.l1 = centres, l1
        self.norms = (centres * centres).sum(axis=1)
        self.rows = self.least = self.most = None

    def distances(self, x: np.ndarray) -> np.ndarray:
        if self.l1:
            return _distances(x, self.centres, True)
        d = (x * x).sum(axis=1)[:, None] + self.norms[None, :] - 2 * x @ self.centres.T
        return np.sqrt(np.maximum(d, 0))

    def groups(self, wanted: int) -> np.ndarray:
        """The group of every cell: neighbouring cells up to about ``wanted`` train rows."""
        heads = self.centres[:max(1, -(-int(self.rows.sum()) // wanted))]
        d = _Cells(heads, self.l1).distances(self.centres)
        near = d.argmin(axis=1)
        order = np.lexsort((d.min(axis=1), near))
        before = np.cumsum(self.rows[order]) - self.rows[order]
        out = np.zeros(len(order), np.int64)
        out[order] = np.unique(before // wanted, return_inverse=True)[1]
        return out

    def home(self, d: np.ndarray, wanted: int) -> np.ndarray:
        """Which cells each test row visits first: its nearest ones, until they hold ``wanted``
        train rows."""
        order = np.argsort(d, axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        out = np.zeros(d.shape, bool)
        np.put_along_axis(out, order, before < wanted, axis=1)
        return out & (self.rows > 0)

    def least_distance(self, d: np.ndarray, size: np.ndarray) -> np.ndarray:
        """No train row of a cell is nearer to the test row than this: by the triangle
        inequality on the cell's bounds, and because its rows have no nearer centre."""
        bound = np.maximum(d - self.most, self.least - d)
        bound = np.maximum(bound, (d - d.min(axis=1, keepdims=True)) / 2)
        return bound - SLACK * (1 + size[:, None] + np.abs(self.centres).max(initial=0.0) * self.centres.shape[1])


def knn_neighbors(train: DataFrame, test: DataFrame, id_col: str, label: str, feats: list[str] | str,
                  k: int, metric: str = "l2", block: int | None = None, exclude: str | None = None,
                  cells: int | None = None) -> DataFrame:
    """(test_id, nb_id, nb_label, dist, nb_rank) for the k nearest train rows of every
    test row, exactly. Ties in distance are broken by the smaller train id. With
    ``exclude`` (a column of both frames, e.g. a cross-validation fold) train rows with
    the test row's value are no neighbours of it. Rows with a null or NaN feature neither
    are nor have neighbours.

    Train rows are dealt to cells by their nearest centre (about the square root of their
    number of rows, ``MAX_CELLS`` at most), neighbouring cells to groups of about ``block``
    rows. A test row first visits the groups of its nearest cells, which gives a k-th distance,
    then the groups with a cell that may hold a row that is not farther: its bound is at
    most that distance. A test row is sent once to a group that it visits, however many of
    its cells it asks for, a train row to one group; groups are split into blocks, so that
    a task holds at most about ``block`` x ``block`` rows. Distances are first found but
    for rounding, and those that may be among the k nearest then exactly.
    """
    l1 = metric == "l1"
    skip = F.col(exclude).cast("string") if exclude else F.lit(None).cast("string")
    tr = train.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("long").alias("_y"), skip.alias("_g"), _vector(feats).alias("_v"))
    te = test.select(F.col(id_col).cast("long").alias("_id"), skip.alias("_g"), _vector(feats).alias("_v"))
    empty = train.sparkSession.createDataFrame([], "test_id long, nb_id long, nb_label long, dist double, nb_rank int")
    whole = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x))
    tr, te = tr.filter(whole), te.filter(whole)
    n = tr.count()
    if not n:
        return empty
    n_cells = cells or min(MAX_CELLS, math.ceil(math.sqrt(n)))
    block = block or min(16384, max(1024, -(-n // BLOCKS)))
    # centres: the first rows in hash order, a bounded sample that only sets the cells' shape
    picked = tr.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(n_cells).select("_v").collect()
    n_cells = len(picked)
    where = _Cells(np.array([r["_v"] for r in picked]), l1)
    width = where.centres.shape[1]
    step = max(1, HELD // len(where.centres))

    def deal(batches):
        for b in batches:
            x = _matrix(b.column("_v"), width)
            near = [(d.argmin(axis=1), d.min(axis=1)) for d in (where.distances(x[i:i + step]) for i in range(0, len(x), step))]
            cell, dist = (np.concatenate(z) if z else np.zeros(0) for z in (list(zip(*near)) or [[], []]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(dist)], names=[*b.schema.names, "cell", "_d"])

    dealt = cut_lineage(tr.mapInArrow(deal, "_id long, _y long, _g string, _v array<double>, cell int, _d double"))
    where.rows, where.least, where.most = np.zeros(n_cells, np.int64), np.full(n_cells, np.inf), np.full(n_cells, -np.inf)
    for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("_d").alias("a"), F.max("_d").alias("b")).collect():  # a row per cell
        where.rows[r["cell"]], where.least[r["cell"]], where.most[r["cell"]] = r["n"], r["a"], r["b"]

    group = where.groups(block)
    n_groups = int(group.max()) + 1
    by_group = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[by_group], np.arange(n_groups))
    dealt = dealt.withColumn("cell", F.element_at(F.array(*[F.lit(int(g)) for g in group]), F.col("cell") + 1))  # the group from here on
    group_rows = np.bincount(group, weights=where.rows, minlength=n_groups).astype(np.int64)

    def visits(queries: DataFrame, again: bool) -> DataFrame:
        """queries by the groups they visit: first at home, then the others within ``_t``."""
        def visit(batches):
            any_of = lambda go: np.logical_or.reduceat(go[:, by_group], starts, axis=1)
            for b in batches:
                x = _matrix(b.column("_v"), width)
                limit = b.column("_t").to_numpy(zero_copy_only=False)
                for i in range(0, len(x), step):
                    part = x[i:i + step]
                    d = where.distances(part)
                    go = any_of(where.home(d, HOME_ROWS * k))
                    if again:
                        size = np.abs(part).max(axis=1, initial=0.0) * width
                        go = ~go & any_of((where.rows > 0) & (where.least_distance(d, size) <= limit[i:i + step, None]))
                    row, cell = np.nonzero(go)
                    for j in range(0, len(row), SENT):  # a row is copied for every group it visits
                        rows = b.select(["_id", "_g", "_v", "_t"]).take(pa.array(row[j:j + SENT] + i))
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell[j:j + SENT].astype(np.int32))], names=["_id", "_g", "_v", "_t", "cell"])

        return queries.mapInArrow(visit, "_id long, _g string, _v array<double>, _t double, cell int")

    out_schema = pa.schema([("test_id", pa.int64()), ("nb_id", pa.int64()), ("nb_label", pa.int64()), ("dist", pa.float64())])

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return out_schema.empty_table()
        xa, xb = _matrix(a.column("_v"), width), _matrix(b.column("_v"), width)
        if exclude:
            code = {g: c for c, g in enumerate({*a.column("_g").unique().to_pylist(), *b.column("_g").unique().to_pylist()})}
            ga, gb = (np.array([code[g] for g in x.column("_g").to_pylist()], np.int32) for x in (a, b))
        limit = a.column("_t").to_numpy()
        ids, labels = b.column("_id").to_numpy(), b.column("_y").combine_chunks()
        of, out, some = a.column("_id").combine_chunks(), [], max(1, HELD // len(xb))
        for i in range(0, len(xa), some):
            d, slack, share = _near_distances(xa[i:i + some], xb, l1)
            if exclude:
                d[ga[i:i + some, None] == gb[None, :]] = np.inf
            at = limit[i:i + some] if l1 else limit[i:i + some] ** 2 * (1 + 1e-12)  # a row that isn't nearer than k known ones doesn't count
            if not np.isfinite(at).all() and k < len(xb):
                at = np.minimum(at, np.partition(d, k - 1, axis=1)[:, k - 1])
            with np.errstate(invalid="ignore"):
                # both the k-th and the row may be off by the rounding; an infinite distance is none
                rows, cols = np.nonzero((d <= (at * (1 + 2 * share) + 2 * slack)[:, None]) & (d < np.inf))
            for lo, hi in _cuts(rows, HELD):
                r, c = rows[lo:hi], cols[lo:hi]
                dist = _pair_distances(xa[i + r], xb[c], l1)
                order = np.lexsort((ids[c], dist, r))
                r, c, dist = r[order], c[order], dist[order]
                first = np.arange(len(r)) - np.searchsorted(r, r) < k
                keep = first & np.isfinite(dist)
                r, c, dist = r[keep], c[keep], dist[keep]
                out.append(pa.table([of.take(pa.array(r + i)), pa.array(ids[c]), labels.take(pa.array(c)),
                                     pa.array(dist if l1 else np.sqrt(dist))], schema=out_schema))
        return pa.concat_tables(out) if out else out_schema.empty_table()

    def meet(visiting: DataFrame) -> DataFrame:
        """The k nearest of every test row among the groups it visits."""
        visiting = cut_lineage(visiting)
        n_visits = {r["cell"]: r["count"] for r in visiting.groupBy("cell").count().collect()}  # a row per group
        count = lambda counts, c: max(1, -(-int(counts.get(c, 0)) // block))
        parts = lambda counts: F.element_at(F.array(*[F.lit(count(counts, c)) for c in range(n_groups)]), F.col("cell") + 1)
        rows = dict(enumerate(group_rows))
        of_train, of_test = parts(rows), parts(n_visits)
        a = (visiting.withColumn("_q", F.pmod(F.xxhash64("_id"), of_test).cast("int"))
                     .withColumn("_p", F.explode(F.sequence(F.lit(0), of_train - 1))))
        b = (dealt.filter(F.array_contains(F.array(*[F.lit(c) for c in sorted(n_visits)]), F.col("cell")) if n_visits else F.lit(False))
                  .withColumn("_p", F.pmod(F.xxhash64("_id"), of_train).cast("int"))
                  .withColumn("_q", F.explode(F.sequence(F.lit(0), of_test - 1))))
        keys = ["cell", "_p", "_q"]
        # few bytes, much work: as many tasks as blocks meet, not as the bytes would ask for
        tasks = min(MAX_CELLS, 2 * sum(count(rows, c) * count(n_visits, c) for c in n_visits) + 1)
        a, b = a.repartition(tasks, *keys), b.drop("_d").repartition(tasks, *keys)
        return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(nearest, "test_id long, nb_id long, nb_label long, dist double")

    def first_k(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("test_id").orderBy("dist", "nb_id")
        return found.withColumn("nb_rank", F.row_number().over(w)).filter(F.col("nb_rank") <= k)

    near = cut_lineage(first_k(meet(visits(te.withColumn("_t", F.lit(float("inf"))), False))))
    limit = near.groupBy("test_id").agg(F.max("dist").alias("_t"), F.count(F.lit(1)).alias("_n"))
    rest = te.join(limit, te["_id"] == limit["test_id"], "left").select(
        "_id", "_g", "_v", F.when(F.col("_n") >= k, F.col("_t")).otherwise(F.lit(float("inf"))).alias("_t"))
    far = meet(visits(rest, True))
    return first_k(near.drop("nb_rank").unionByName(far))


def knn_vote(neigh: DataFrame, k: int | None = None, weighted: bool = False,
             k_col: str | None = None, extra_keys: list[str] | None = None) -> DataFrame:
    """Majority (or 1/distance-weighted) vote; ties go to the smallest label. Weighted,
    the neighbours at distance 0, if any, decide alone.
    With ``k_col`` the vote is per (test_id, k); ``extra_keys`` (e.g. a fold) are
    kept in the key."""
    n = neigh if k is None else neigh.filter(F.col("nb_rank") <= k)
    keys = (extra_keys or []) + ["test_id"] + ([k_col] if k_col else [])
    if weighted:
        # neighbours at distance 0 alone vote, one vote each
        same = n.groupBy(*keys).agg(F.max(F.col("dist") == 0).alias("_same"))
        n = n.join(same, keys).filter(~F.col("_same") | (F.col("dist") == 0))
    wgt = F.coalesce(F.try_divide(F.lit(1.0), F.col("dist")), F.lit(1.0)) if weighted else F.lit(1.0)
    votes = n.groupBy(*keys, "nb_label").agg(F.sum(wgt).alias("_v"))
    return votes.groupBy(*keys).agg(
        F.min_by("nb_label", F.struct(-F.col("_v"), F.col("nb_label"))).alias("pred"))


def knn_cv_grid(df: DataFrame, id_col: str, label: str, feats: list[str], fold: str, ks: list[int],
                metrics: tuple = ("l2", "l1")) -> DataFrame:
    """Cross-validated KNN grid: every (metric, weighting, k) scored as the mean
    over folds of the held-out accuracy. Per metric ONE neighbour search covers all
    folds (rows of a row's own fold are no neighbours of it) and all k and weightings
    come from that top-max(k) table."""
    rows = df.select(id_col, label, fold, *([feats] if isinstance(feats, str) else feats))
    truth = df.select(F.col(id_col).alias("test_id"), F.col(label).cast("long").alias("_y"), fold)
    out = None
    for metric in metrics:
        # read by every weighting: one search, kept as a table
        nb = cut_lineage(knn_neighbors(rows, rows, id_col, label, feats, max(ks), metric=metric, exclude=fold))
        kk = nb.withColumn("k", F.explode(F.filter(F.array(*[F.lit(k) for k in ks]),
                                                   lambda x: x >= F.col("nb_rank"))))
        for weighted in (False, True):
            v = knn_vote(kk, weighted=weighted, k_col="k")
            acc = (v.join(truth, "test_id")
                    .groupBy(fold, "k").agg(F.avg((F.col("pred") == F.col("_y")).cast("double")).alias("acc"))
                    .groupBy("k").agg(F.avg("acc").alias("mean_accuracy"))
                    .select(F.lit(metric).alias("metric"), F.lit("distance" if weighted else "uniform").alias("weighting"),
                            "k", "mean_accuracy"))
            out = acc if out is None else out.unionByName(acc)
    return out


def knn_k_sweep(neigh: DataFrame, truth: DataFrame, id_col: str, label: str, k_max: int) -> DataFrame:
    """Accuracy and error for k = 1..k_max from ONE top-k_max neighbour table."""
    ks = neigh.withColumn("k", F.explode(F.sequence(F.col("nb_rank").cast("int"), F.lit(k_max))))
    pred = knn_vote(ks, k_col="k")
    j = pred.join(truth.select(F.col(id_col).alias("test_id"), F.col(label).cast("long").alias("_y")), "test_id")
    return j.groupBy("k").agg(F.avg((F.col("pred") == F.col("_y")).cast("double")).alias("accuracy")) \
            .withColumn("error_rate", 1 - F.col("accuracy"))


# ---------------------------------------------------------------- Gaussian naive Bayes

def _long(df: DataFrame, id_col: str, feats: list[str], extra: list[str] | None = None) -> DataFrame:
    return df.select(id_col, *(extra or []), F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), F.col(c).cast("double").alias("x")) for j, c in enumerate(feats)
    ])).alias("s")).select(id_col, *(extra or []), "s.j", "s.x")


def fit_gaussian_nb(train: DataFrame, label: str, feats: list[str], var_smoothing: float = 1e-9) -> DataFrame:
    """Model table (cls, j, mu, var, log_prior): per-class mean and population
    variance, plus ``var_smoothing`` × the largest feature variance."""
    lg = _long(train, label, feats)
    st = lg.groupBy(F.col(label).alias("cls"), "j").agg(F.avg("x").alias("mu"), F.var_pop("x").alias("var"),
                                                         F.count("x").alias("n_c"))
    eps = lg.groupBy("j").agg(F.var_pop("x").alias("v")).agg((F.max("v") * var_smoothing).alias("_eps"))
    n = train.agg(F.count(F.lit(1)).alias("_n"))
    m = attach_scalar(attach_scalar(st, eps), n)
    return m.select("cls", "j", "mu", (F.col("var") + F.col("_eps")).alias("var"),
                    F.log(F.col("n_c") / F.col("_n")).alias("log_prior"))


def predict_gaussian_nb(model: DataFrame, test: DataFrame, id_col: str, feats: list[str]) -> DataFrame:
    """argmax_c log prior + Σ_j log N(x_j; mu_cj, var_cj); ties → smallest class.
    The model table has classes × features rows; Spark broadcasts it if its size allows."""
    lg = _long(test, id_col, feats)
    t = lg.join(model, "j")
    ll = -0.5 * (F.lit(LOG_2PI) + F.log("var")) - 0.5 * (F.col("x") - F.col("mu")) ** 2 / F.col("var")
    s = t.groupBy(id_col, "cls").agg((F.max("log_prior") + F.sum(ll)).alias("jll"))
    return s.groupBy(id_col).agg(F.min_by("cls", F.struct(-F.col("jll"), F.col("cls"))).alias("pred"))


def centroid_scores(df: DataFrame, label: str, vec: str, classes: list[int], prefix: str = "p", pred: str = "pred") -> DataFrame:
    """Nearest-centroid classifier over the whole vector ``vec``: adds, per class k, the score
    ``p<k>`` = exp(-d_k) scaled to sum 1 (d_k: squared distance to the mean vector of its
    rows; 9 places) and ``pred``, the class of the least distance (9 places; ties: the first).

    The centroids (classes x width numbers) are one aggregate, read back as one row and
    attached as literals. A class without rows has score 0; a null vector has null scores.
    """
    c = class_centroids(df, label, vec)
    model = c.agg(*[F.max(F.when(F.col(label) == k, F.col("centroid"))).alias(f"_c{k}") for k in classes])

    def distance(k):
        parts = F.zip_with(F.col(vec), F.col(f"_c{k}"), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
        return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)

    d = attach_scalar(df, model)
    d = d.withColumns({f"_d{k}": distance(k) for k in classes}).drop(*[f"_c{k}" for k in classes])
    d = d.withColumn("_least", F.least(*[F.col(f"_d{k}") for k in classes]))
    d = d.withColumns({f"_e{k}": F.when(F.col("_least").isNotNull(), F.coalesce(F.exp(F.col("_least") - F.col(f"_d{k}")), F.lit(0.0))) for k in classes})
    total = sum((F.col(f"_e{k}") for k in classes), F.lit(0.0))
    nearest = F.coalesce(*[F.when(F.round(f"_d{k}", 9) == F.round("_least", 9), F.lit(k).cast("long")) for k in classes])
    d = d.withColumns({**{f"{prefix}{k}": F.round(F.col(f"_e{k}") / total, 9) for k in classes}, pred: nearest})
    return d.drop("_least", *[f"_{x}{k}" for x in "de" for k in classes])
