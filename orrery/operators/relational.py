"""Filters, profiles, summaries, reshaping (survey 2.2, 2.4, 2.6, 2.7).

Every summary is one aggregation with partial (map-side) combine; nothing is
collected. Exact quantiles avoid the single-buffer ``percentile`` aggregate: a sketch
brackets the requested ranks, and only the rows inside are ranked (``rank_select``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.scalar_join import attach_scalar
from orrery.operators.rank_select import rows_at
from orrery.operators.skew import explode_count, ranked


# ---------------------------------------------------------------- filters

def contains_filter(df: DataFrame, col: str, needle: str, negate: bool = False) -> DataFrame:
    """Substring filter. A NULL text is dropped both ways (three-valued logic)."""
    cond = F.col(col).contains(needle)
    return df.filter(~cond if negate else cond)


def prefix_filter(df: DataFrame, col: str, prefix: str, not_col: str | None = None,
                  not_value=None) -> DataFrame:
    cond = F.col(col).startswith(prefix)
    if not_col is not None:
        cond = cond & (F.col(not_col) != F.lit(not_value))
    return df.filter(cond)


def row_slice(df: DataFrame, order: list, start: int, stop: int) -> DataFrame:
    """Rows ``start`` (inclusive) .. ``stop`` (exclusive), 0-based, under a total order
    (nulls first).

    The order keys at both ends are found by ``rank_select.rows_at``; the table is then
    filtered by them, and only the slice is put in order.
    """
    names = [f"_k{i}" for i in range(len(order))]
    # a null is before every value: each key becomes (is not null, value)
    keys = df.select(*[F.struct(F.col(c).isNotNull().alias("has"), F.col(c).alias("value")).alias(k) for c, k in zip(order, names)])
    kind = dict(df.select(*order).dtypes)[order[0]]
    numeric = kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))
    first = F.col("_k0.value").cast("double") if numeric else F.lit(0.0)  # other kinds: all rows are in the bracket
    keys = keys.withColumn("_v", F.coalesce(first, F.lit(float("-inf"))))
    n = keys.count()
    if start >= min(stop, n):
        return df.limit(0).withColumn("row_pos", F.lit(0).cast("long"))
    ends = rows_at(keys, "_v", names, [("first", start / n, F.lit(start)), ("last", (min(stop, n) - 1) / n, F.lit(min(stop, n) - 1))])
    ends = {r["tag"]: r for r in ends.collect()}  # two rows
    kinds = dict(df.select(*order).dtypes)
    pair = lambda has, x: F.struct(has.alias("has"), x.alias("value"))
    literal = lambda tag: F.struct(*[pair(F.lit(ends[tag][k]["has"]), F.lit(ends[tag][k]["value"]).cast(kinds[c])).alias(k)
                                     for c, k in zip(order, names)])
    key = F.struct(*[pair(F.col(c).isNotNull(), F.col(c)).alias(k) for c, k in zip(order, names)])
    inside = df.filter((key >= literal("first")) & (key <= literal("last")))
    if ends["first"]["_k0"]["has"]:  # a bound that reaches the scan
        inside = inside.filter((F.col(order[0]) >= F.lit(ends["first"]["_k0"]["value"])) & (F.col(order[0]) <= F.lit(ends["last"]["_k0"]["value"])))
    return ranked(inside, order, out="_pos").withColumn("row_pos", F.col("_pos") - 1 + start).drop("_pos")


# ---------------------------------------------------------------- profiles

def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_null, n_rows): one aggregation pass, then a narrow unpivot."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                          F.col(f"_n_{i}").alias("n_null")) for i, c in enumerate(cols)]))
    return agg.select(stack.alias("s"), "n_rows").select("s.column_name", "s.n_null", "n_rows")


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_distinct). Each column is deduplicated by its own partial
    aggregate (Spark expands the rows once per distinct column and combines
    map-side), so no value set is built in one buffer."""
    agg = df.agg(*[F.count_distinct(F.col(c)).alias(f"_d_{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                          F.col(f"_d_{i}").alias("n_distinct")) for i, c in enumerate(cols)]))
    return agg.select(stack.alias("s")).select("s.*")


def shape(df: DataFrame, name: str) -> DataFrame:
    """(table, n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    """(label, n, pct): counts per class over the row count, attached as a literal."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    c = attach_scalar(c, df.agg(F.count(F.lit(1)).alias("_all")))
    return c.withColumn("pct", F.col("n") * 100.0 / F.col("_all")).drop("_all")


# ---------------------------------------------------------------- exact quantiles

def _quantiles(df: DataFrame, cols: list[str], probs: list[float], extra: list | None = None) -> DataFrame:
    """(column_name, prob, value, n) and the aggregates ``extra`` of each column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(c).cast("double").alias("v"))
                                          for c in cols])).alias("s")).select("s.*")
    # wanted 0-based ranks: floor(h) and ceil(h), h = (n - 1) * p
    h = lambda p: (F.col("n") - 1) * F.lit(float(p))
    at = [(f"{side}{i}", float(p), f(h(p))) for i, p in enumerate(probs) for side, f in (("lo", F.floor), ("hi", F.ceil))]
    got = rows_at(long, "v", ["v"], at, groups=["column_name"], extra=extra)
    prob = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.substring("tag", 3, 9).cast("int"))
    side = lambda s: F.max(F.when(F.substring("tag", 1, 2) == s, F.col("v")))
    rest = [c for c in got.columns if c not in ("column_name", "tag", "v")]
    g = got.withColumn("prob", prob).groupBy("column_name", "prob", *rest).agg(side("lo").alias("lo"), side("hi").alias("hi"))
    rank = (F.col("n") - 1) * F.col("prob")
    return g.withColumn("value", F.col("lo") + (rank - F.floor(rank)) * (F.col("hi") - F.col("lo"))).drop("lo", "hi")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / R type 7) per column: (column_name,
    prob, value). Null values don't count. See ``rank_select``."""
    return _quantiles(df, cols, probs).select("column_name", "prob", "value")


def describe_exact(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact), max per column. The moments come
    from the pass that builds the quantile sketch. A column without values: no row."""
    extra = [F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")]
    q = _quantiles(df, cols, [0.25, 0.5, 0.75], extra)
    return q.groupBy("column_name", "count", "mean", "std", "min", "max").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]])


# ---------------------------------------------------------------- group summaries

def mean_se(df: DataFrame, value: str, sets: list[list[str]], all_cols: list[str]) -> DataFrame:
    """Mean, sample std and standard error of ``value`` for several groupings in ONE
    pass (GROUPING SETS); ``gid`` tells the grouping apart."""
    v = F.col(value).cast("double")
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *all_cols).agg(
        F.grouping_id().alias("gid"), F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("sd"), (F.stddev_samp(v) / F.sqrt(F.count(v))).alias("se"))


def argmin_row(df: DataFrame, group: list[str], by: str, tiebreak: list[str], cols: list[str],
               largest: bool = False) -> DataFrame:
    """The row with the smallest (largest) ``by`` per group, ties broken by the
    lowest ``tiebreak`` key — a one-pass ``min_by`` on a struct order key."""
    key = F.struct(F.col(by) if not largest else -F.col(by), *[F.col(c) for c in tiebreak])
    packed = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*group).agg(F.min_by(packed, key).alias("_r"))
              .select(*group, *[F.col("_r")[c].alias(c) for c in cols]))


def group_mean_all(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    return df.groupBy(*group).agg(*[F.avg(F.col(c)).alias(f"mean_{c}") for c in cols])


# ---------------------------------------------------------------- reshape

def unpivot_long(df: DataFrame, ids: list[str], values: list[str], var: str = "metric",
                 val: str = "value") -> DataFrame:
    return df.unpivot(ids, values, var, val)


def transpose(df: DataFrame, key: str, columns: list[str], keys: list, name: str = "name") -> DataFrame:
    """Rows to columns and back: one row per entry of ``columns``, one column per entry of
    ``keys`` (the values of ``key``; each should occur once, the last of several wins by size)."""
    long = df.unpivot([key], columns, name, "_v")
    return long.groupBy(name).pivot(key, keys).agg(F.max("_v"))


def dense_codes(df: DataFrame, value: str, first_seen: str, out: str = "code") -> DataFrame:
    """0-based codes for the distinct values of ``value`` in order of first
    appearance (the smallest ``first_seen`` key). The ranking of distinct values is
    the distributed ``ranked`` (no single-partition window)."""
    firsts = df.groupBy(value).agg(F.min(first_seen).alias("_first"))
    r = ranked(firsts, ["_first", value], out="_rk")
    return r.select(value, "_first", (F.col("_rk") - 1).alias(out))


def expand_counts(df: DataFrame, keys: list[str], trials: str, successes: str,
                  out: str = "result") -> DataFrame:
    """(keys, trials, successes) → one row per trial with ``out`` 1 (success) or 0,
    i.e. ``Failed = trials - successes`` zeros stacked under the ones. Chunked, so
    a huge count is spread over tasks."""
    base = df.select(*keys, F.col(successes).cast("long").alias("_ok"),
                     (F.col(trials) - F.col(successes)).cast("long").alias("_ko"))
    ones = explode_count(base.select(*keys, F.col("_ok").alias("_n")), "_n").select(
        *keys, F.lit(1).alias(out))
    zeros = explode_count(base.select(*keys, F.col("_ko").alias("_n")), "_n").select(
        *keys, F.lit(0).alias(out))
    return ones.unionByName(zeros)


def stack_frames(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
