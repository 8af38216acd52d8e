"""Rows at given ranks without a global sort (survey D7, B15, G7, G8).

1. A mergeable quantile sketch per group brackets every wanted rank between two values.
2. One pass counts the rows below and inside each bracket; a bracket that misses its rank
   (the sketch's error is bounded, so none should) is replaced by everything.
3. Only the rows inside the brackets are put in order, by a distributed running count.

The passes read the columns of the order alone; nothing but the brackets' inner rows is
written or sorted.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.skew import running_total
from orrery.session import cut_lineage

ACCURACY = 10_000  # of the sketch: ranks are right within n / ACCURACY
MOST_BROADCAST = 50_000  # groups whose brackets are broadcast; more are joined by shuffles
BRACKET = [("tag", "string"), ("pos", "long"), ("lo", "double"), ("hi", "double")]


def _same(a: list[str], b: list[str]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b):
        out = out & F.col(x).eqNullSafe(F.col(y))
    return out


def attach_scalar_arrays(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row frames side by side, the second (counts) as literals."""
    row = other.select("_counts").first()
    cells = [F.struct(F.lit(e["below"]).cast("long").alias("below"), F.lit(e["inside"]).cast("long").alias("inside")) for e in row["_counts"]]
    return one.withColumn("_counts", F.array(*cells))


def rows_at(df: DataFrame, value: str, order: list[str], at: list[tuple[str, float, Column]],
            groups: list[str] | None = None, extra: list[Column] | None = None) -> DataFrame:
    """groups, ``tag``, ``n`` (rows of the group), the ``order`` columns of the row that stands
    at each wanted position, and the aggregates ``extra`` of each group.

    ``order`` is a total order (equal rows are interchangeable) that refines the order by the
    numeric column ``value``. ``at`` has a tag, the share of rows before the position (about,
    for the sketch) and the 0-based position as an expression in ``n``; positions outside the
    group give no row. Null groups are a group; rows with a null ``value`` are not looked at.
    """
    groups = groups or []
    names = [f"_g{i}" for i in range(len(groups))]
    theirs = [f"_h{i}" for i in range(len(groups))]
    rows = df.filter(F.col(value).isNotNull())
    error = 2.0 / ACCURACY
    shares = [min(1.0, max(0.0, s + d)) for _, s, _ in at for d in (-error, error)]
    sketch = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(value, shares, ACCURACY).alias("_q"), *(extra or []))
    extra_names = [c for c in sketch.columns if c not in (*groups, "n", "_q")]
    ends = F.array(*[F.struct(F.lit(t).alias("tag"), p.cast("long").alias("pos"), F.get("_q", F.lit(2 * i)).cast("double").alias("lo"),
                              F.get("_q", F.lit(2 * i + 1)).cast("double").alias("hi")) for i, (t, _, p) in enumerate(at)])
    # one row per group, read by the counting and by the inner pass
    brackets = cut_lineage(sketch.filter("n > 0").select(*[F.col(g).alias(x) for g, x in zip(groups, names)], "n", *extra_names, ends.alias("_w")))
    few = brackets.count() <= MOST_BROADCAST
    keyed = rows.select(*dict.fromkeys([*groups, value, *order]))
    v = F.col(value)

    def attach(found: DataFrame) -> DataFrame:
        """The rows with the brackets ``_w`` of their group."""
        if groups:
            found = found.select(*names, "_w")
            return keyed.join(F.broadcast(found) if few else found, _same(groups, names))
        row = found.select("_w").first()  # one row: as a literal
        cells = [F.struct(*[F.lit(x).cast(k).alias(c) for (c, k), x in zip(BRACKET, e)]) for e in (row["_w"] if row else [])]
        return keyed.withColumn("_w", F.array(*cells) if cells else F.lit(None).cast("array<struct<tag:string,pos:long,lo:double,hi:double>>"))

    inside = lambda e: (v >= e["lo"]) & (v <= e["hi"])
    tags = range(len(at))
    counted = attach(brackets).groupBy(*names).agg(*[F.count_if(v < F.col("_w")[i]["lo"]).alias(f"_below{i}") for i in tags],
                                                   *[F.count_if(inside(F.col("_w")[i])).alias(f"_inside{i}") for i in tags])
    counted = counted.select(*[F.col(x).alias(y) for x, y in zip(names, theirs)], F.array(*[F.struct(
        F.col(f"_below{i}").alias("below"), F.col(f"_inside{i}").alias("inside")) for i in tags]).alias("_counts"))
    b = (brackets.join(counted, _same(names, theirs)) if groups else attach_scalar_arrays(brackets, counted)).drop(*theirs)
    b = b.select(*names, "n", *extra_names, F.explode(F.arrays_zip("_w", "_counts")).alias("_e")).select(*names, "n", *extra_names, "_e._w.*", "_e._counts.*")
    hit = (F.col("pos") >= F.col("below")) & (F.col("pos") < F.col("below") + F.col("inside"))
    # a bracket without its rank: everything is looked at
    wide = lambda c, x: F.when(hit, F.col(c)).otherwise(F.lit(x)).alias(c)
    b = b.filter((F.col("pos") >= 0) & (F.col("pos") < F.col("n")))
    b = cut_lineage(b.select(*names, "n", *extra_names, "tag", "pos", wide("lo", float("-inf")).cast("double").alias("lo"),
                             wide("hi", float("inf")).cast("double").alias("hi"), wide("below", 0)))
    again = b.groupBy(*names).agg(F.collect_list(F.struct("tag", "pos", F.col("lo"), F.col("hi"))).alias("_w"))
    ends = [F.get("_w", F.lit(i)) for i in tags]
    inner = attach(again).filter(reduce(or_, [F.coalesce(inside(e), F.lit(False)) for e in ends]))  # few rows are left
    inner = inner.select(*names, F.explode(F.array_compact(F.array(*[F.when(inside(e), e) for e in ends]))).alias("_e"), *order)
    inner = inner.groupBy(*names, F.col("_e.tag").alias("_tag"), *order).agg(F.count(F.lit(1)).alias("_c"))
    inner = running_total(inner, order, "_c", partition=[*names, "_tag"], out="_end")
    inner = inner.select(*[F.col(x).alias(y) for x, y in zip(names, theirs)], "_tag", *order, "_c", "_end")
    at_rank = (F.col("below") + F.col("_end") > F.col("pos")) & (F.col("below") + F.col("_end") - F.col("_c") <= F.col("pos"))
    got = b.join(inner, _same(names, theirs) & (F.col("tag") == F.col("_tag")) & at_rank)
    return got.select(*[F.col(x).alias(g) for g, x in zip(groups, names)], "tag", "n", *extra_names, *order)
