"""Shared helpers: words, written intermediate tables, distributed running sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.session import ensure_checkpoint_dir
from orrery.sources.tables import read_table  # noqa: F401  (used by the operators' queries)

# white space that separates words: space and code points 9 to 13
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than white space (null: empty)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    app = spark.sparkContext.applicationId
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/orrery-llm-{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage at a columnar copy that every executor can read, so the work
    below runs once and survives the loss of executors. The folder belongs to the
    application (``orrery-llm-<application id>``) and can be removed when it ends.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores appended until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Inclusive running sum of the long column ``value`` within ``groups`` along ``order``.

    No task holds a group: rows are range-partitioned on (groups, order), so a hot
    group spans many partitions; each partition's rows are summed by a window of its
    own and shifted by the total of the group's earlier partitions (a table of at
    most partitions + groups rows). Null groups are a group. Rows that tie in
    ``groups`` and ``order`` should be interchangeable.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *groups, *order).withColumn("__part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    totals = ranged.groupBy("__part", *groups).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__part").alias("__p"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
                            F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    here = Window.partitionBy("__part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("__part") == F.col("__p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return (ranged.withColumn("__local", F.sum(value).over(here))
                  .join(offsets, same)
                  .withColumn(out, F.col("__offset") + F.col("__local"))
                  .drop("__part", "__p", "__offset", "__local", *[f"__g{i}" for i in range(len(groups))]))
