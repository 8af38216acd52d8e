"""Skew-safe building blocks.

* ``ranked`` — a global (or per-group) row number without a single-partition window:
  range-partition on (group, order), count rows per range partition (a table of at
  most partitions + groups rows), prefix-sum those counts, and add the offset to a
  row number inside each range partition. A hot group is spread over several range
  partitions because the order columns split it.
* ``salted_self_join`` — self equi-join where keys with many rows are split into as
  many sub-keys as their size asks for on one side and replicated on the other, so a
  key holding a third of all rows is worked on by many tasks.
* ``explode_count`` — expand (row, n) into n rows in bounded chunks, so one huge
  count does not become one huge array in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import cut_lineage


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def ranked(df: DataFrame, order: list, partition: list[str] | None = None,
           out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number of each row within ``partition`` (or globally) under
    the total order ``order``. Ties must be broken by the caller (include a key).

    One shuffle: range partitioning on (partition, order) with a sort inside each
    range partition, materialised by a reliable checkpoint. On the checkpoint the
    position of a row inside its range partition is fixed, so
    ``monotonically_increasing_id`` (partition index << 33 | position) gives it
    without another shuffle. A small table of (range partition, group) → first
    position and row count yields the offsets; it has one row per range partition
    when ranking globally (broadcast, bounded by the partition count).
    """
    partition = partition or []
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(partition) + _cols(order)
    r = cut_lineage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    r = (r.withColumn("__rk_pid", F.spark_partition_id())
          .withColumn("__rk_idx", F.monotonically_increasing_id() - F.shiftleft(F.col("__rk_pid").cast("long"), 33)))
    firsts = r.groupBy("__rk_pid", *partition).agg(F.min("__rk_idx").alias("__rk_first"), F.count(F.lit(1)).alias("__rk_n"))
    wo = Window.partitionBy(*partition).orderBy("__rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.withColumn("__rk_off", F.coalesce(F.sum("__rk_n").over(wo), F.lit(0))).drop("__rk_n")
    return (_with_offsets(r, offsets, partition)
            .withColumn(out, F.col("__rk_off") + F.col("__rk_idx") - F.col("__rk_first") + 1)
            .drop("__rk_pid", "__rk_idx", "__rk_first", "__rk_off"))


def _with_offsets(r: DataFrame, offsets: DataFrame, partition: list[str]) -> DataFrame:
    """Join the offsets of each (range partition, group); null groups are a group. Left
    to AQE: small tables are broadcast at runtime, large range partitions split."""
    o = offsets.select(F.col("__rk_pid").alias("__o_pid"), *[F.col(g).alias(f"__o_{i}") for i, g in enumerate(partition)],
                       *[c for c in offsets.columns if c not in ("__rk_pid", *partition)])
    same = F.col("__rk_pid") == F.col("__o_pid")
    for i, g in enumerate(partition):
        same = same & F.col(g).eqNullSafe(F.col(f"__o_{i}"))
    return r.join(o, same).drop("__o_pid", *[f"__o_{i}" for i in range(len(partition))])


def running_total(df: DataFrame, order: list, value, partition: list[str] | None = None,
                  out="cum", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum(s) of ``value`` (a column name or a list of them) under
    a total ``order`` (within ``partition``; null groups are a group).

    Range partitioning on (partition, order), materialised by a reliable checkpoint.
    Totals per (range partition, group) give each partition's starting offsets (a table
    of at most partitions + groups rows); a window per (range partition, group) adds
    the running sum inside. Integer and decimal sums stay exact.
    """
    partition = partition or []
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(partition) + _cols(order)
    r = cut_lineage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    r = r.withColumn("__rk_pid", F.spark_partition_id())
    tot = r.groupBy("__rk_pid", *partition).agg(*[F.sum(v).alias(f"__rt_t{i}") for i, v in enumerate(values)])
    wo = Window.partitionBy(*partition).orderBy("__rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select("__rk_pid", *partition, *[F.sum(f"__rt_t{i}").over(wo).alias(f"__rt_o{i}") for i in range(len(values))])
    w = (Window.partitionBy("__rk_pid", *partition).orderBy(*_cols(order))
               .rowsBetween(Window.unboundedPreceding, 0))
    res = r.withColumns({f"__rt_s{i}": F.coalesce(F.sum(v).over(w), F.lit(0)) for i, v in enumerate(values)})
    res = _with_offsets(res, offsets, partition)
    res = res.withColumns({o: F.coalesce(F.col(f"__rt_o{i}"), F.lit(0)) + F.col(f"__rt_s{i}") for i, o in enumerate(outs)})
    return res.drop("__rk_pid", *[f"__rt_{x}{i}" for x in "so" for i in range(len(values))])


def heavy_keys(df: DataFrame, key: str, threshold: int) -> DataFrame:
    """The keys with more than ``threshold`` rows, and into how many parts of at most
    that size each is split. At most rows / threshold keys; the join with it is left to
    AQE, which broadcasts it only if its measured size allows."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"))
              .filter(F.col("_cnt") > threshold)
              .select(key, F.ceil(F.col("_cnt") / threshold).cast("int").alias("_parts")))


def salted_self_join(left: DataFrame, right: DataFrame, key: str, salt_by: Column | str,
                     threshold: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """The sides of ``left ⋈ right`` on (``key``, ``_salt``), heavy keys split into parts of
    about ``threshold`` rows.

    ``salt_by`` is a column of ``left`` hashed into the salt (e.g. the item id), so
    the split is deterministic. Light keys keep salt 0 on both sides and join as a
    plain hash join.
    """
    hk = heavy_keys(left, key, threshold)
    sb = F.col(salt_by) if isinstance(salt_by, str) else salt_by
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    lft = left.join(hk, key, "left").withColumn("_salt", F.pmod(F.xxhash64(sb), parts).cast("int")).drop("_parts")
    rgt = right.join(hk, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return lft, rgt


def explode_count(df: DataFrame, count_col: str, chunk: int = 4096, out: str = "_i") -> DataFrame:
    """One output row per unit of ``count_col`` (rows with count <= 0 vanish).

    Two-level: first one row per chunk of ``chunk`` units (a short array even for
    a huge count), then a round-robin-free hash repartition on the chunk so the
    chunks of one hot row land in different tasks, then the chunk is expanded.
    """
    n = F.col(count_col).cast("long")
    chunks = (df.filter(n > 0)
                .withColumn("_chunk", F.explode(F.sequence(F.lit(0), ((n - 1) / chunk).cast("long"))))
                .withColumn("_len", F.least(F.lit(chunk).cast("long"), n - F.col("_chunk") * chunk)))
    # spread the chunks of a single hot row
    chunks = chunks.repartition(F.xxhash64(*[F.col(c) for c in df.columns], F.col("_chunk")))
    return (chunks.withColumn(out, F.explode(F.sequence(F.lit(1), F.col("_len").cast("int"))))
                  .withColumn(out, F.col("_chunk") * chunk + F.col(out))
                  .drop("_chunk", "_len"))
