"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. A source's demand for words at time t is its target
times ``1 + tilt * (1 - 2 t)``: a positive tilt puts the source early, a negative one
late. The integral of that schedule, ``target * (t + tilt * t * (1 - t))``, is the
source's cumulative demand; inverted, it gives every word of the source, in a fixed
shuffled order, its training time. Documents are range-sorted by the position of
their first word.

Targets: a source shares ``share`` times all words by its weight, but never more than
``max_repeats`` times its own words; what is above is shared again by weight among the
others (water filling, solved in closed form from running sums).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import materialize, n_words, read_table, running_sum
from orrery.operators.scalar_join import attach_scalar

WEIGHTS = (5, 2, 1)
TILTS = (0.5, 0.0, -0.5)
SHARE = 1.5
MAX_REPEATS = 2


def source_targets(sizes: DataFrame, weights=WEIGHTS, tilts=TILTS, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, tilt, target) from rows (source, size).

    Sources in code point order, null last, get the weights and tilts in turn.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.withColumns({"last": F.col("source").isNull(), "one": F.lit(1).cast("long")})
    src = running_sum(src, [], ["last", "source"], "one", "rank")
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), turn + 1)
    src = src.select("source", "last", "source_size", pick(weights).cast("long").alias("weight"),
                     pick(tilts).cast("double").alias("tilt"), (F.col("source_size") * max_repeats).alias("cap"))
    # fill in the order of cap per weight: those before are at their cap
    src = src.withColumn("ratio", F.col("cap") / F.col("weight"))
    src = running_sum(src, [], ["ratio", "last", "source"], "cap", "caps")
    src = running_sum(src, [], ["ratio", "last", "source"], "weight", "weights")
    src = materialize(src, "sources")
    src = attach_scalar(src, src.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight")))
    level = ((F.col("all_size") * F.lit(share) - (F.col("caps") - F.col("cap")))
             / (F.col("all_weight") - F.col("weights") + F.col("weight")))
    src = attach_scalar(src, src.agg(F.max(level).alias("level")))
    return src.select("source", "source_size", "weight", "tilt",
                      F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def time_of(share: Column, tilt: Column) -> Column:
    """Invert ``t + tilt * t * (1 - t) = share`` on [0, 1]."""
    b = tilt + 1
    root = F.sqrt(b * b - tilt * 4 * share)
    return F.when(tilt == 0, share).otherwise((b - root) / (tilt * 2))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights=WEIGHTS, tilts=TILTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, position,
    positions.

    ``taken`` counts words: whole passes over the source, then one more pass in the
    order of md5(doc_id) up to the target, whose last document is cut where the
    target is reached. So each source's taken words equal its target rounded down.
    ``positions`` (array of long) has the place, in words of the mix, at which each
    pass over the document starts, ``position`` the first of them; both are null if
    it isn't taken. The rows come sorted by ``position``.

    Null text: size 0, never taken. Null source: a source, last in order. Null or
    repeated ids: rows of their own; those that also tie in size are interchangeable.
    An empty table gives an empty result. Other columns are not read.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    d = materialize(d.withColumn("shuffle_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "sizes")
    targets = materialize(source_targets(d, weights, tilts, share, max_repeats), "targets")
    targets = attach_scalar(targets, targets.agg(F.sum(F.floor("target")).alias("mix_size")))
    placed = running_sum(d, ["source"], ["shuffle_key", "size"], "size", "upto")
    t = targets.withColumnRenamed("source", "t_source")
    r = placed.join(t, placed.source.eqNullSafe(t.t_source), "left").drop("t_source")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target")) - passes * F.col("source_size")
    start = F.col("upto") - F.col("size")
    r = r.withColumns({
        "taken": (passes * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - start))).cast("long"),
        "start": start,
    })
    at = lambda p: time_of(F.least(F.lit(1.0), (p * F.col("source_size") + F.col("start")) / F.col("target")), F.col("tilt"))
    last = F.floor((F.col("taken") - 1) / F.col("size"))
    r = r.withColumn("positions", F.when(F.col("taken") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), last), lambda p: F.floor(at(p) * F.col("mix_size")))))
    r = r.withColumn("position", F.get("positions", F.lit(0)))
    return (r.orderBy(F.col("position").asc_nulls_last(), "shuffle_key", "size")
             .select("doc_id", "source", "size", "source_size", "target", "taken", "position", "positions"))


def training_stream(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents in training order: a row per document and pass, range-sorted by its
    position, with the document's columns and ``train_position``, ``train_words`` (the
    words that this pass takes). Ids should be unique."""
    m = mixed.filter("taken > 0").select(F.col("doc_id").alias("__id"), F.col("size").alias("__size"),
                                         F.col("taken").alias("__taken"), F.posexplode("positions").alias("__pass", "train_position"))
    m = m.withColumn("train_words", F.least("__size", F.col("__taken") - F.col("__pass") * F.col("__size")))
    return docs.join(m, docs[doc_id].eqNullSafe(m["__id"])).drop("__id", "__size", "__taken", "__pass").orderBy("train_position")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("source", "positions")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM s0),
s2 AS (SELECT source, source_size, CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
       CASE turn WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.5::DOUBLE END AS tilt, source_size * 2 AS cap FROM s1),
s3 AS (SELECT *, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS demand, sum(weight) OVER () AS all_weight,
       sum(cap) OVER w AS caps, sum(weight) OVER w AS weights FROM s2
       WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
s4 AS (SELECT *, max((demand - (caps - cap)::DOUBLE) / (all_weight - weights + weight)::DOUBLE) OVER () AS level FROM s3),
s5 AS (SELECT source, source_size, tilt, least(cap::DOUBLE, weight::DOUBLE * level) AS target FROM s4),
t AS (SELECT *, (SELECT CAST(sum(floor(target)) AS DOUBLE) FROM s5) AS mix_size,
      CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE)::BIGINT ELSE 0 END AS passes FROM s5),
p AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), size
                                     ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start FROM d),
r AS (
  SELECT p.doc_id, p.size, t.source_size, t.target, t.tilt, t.mix_size,
    CAST(passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - start)) AS BIGINT) AS taken,
    least(1.0::DOUBLE, start::DOUBLE / target) AS share
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CAST(floor(mix_size * CASE WHEN tilt = 0 THEN share
    ELSE ((tilt + 1) - sqrt((tilt + 1) * (tilt + 1) - tilt * 4 * share)) / (tilt * 2) END) AS BIGINT) END AS position
FROM r
"""
