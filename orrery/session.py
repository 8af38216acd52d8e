"""Session helpers.

The library never creates a session inside an operator; callers pass one in.
These helpers are for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in the library assumes. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting covers hot join keys that the
# explicit salting in operators.skew does not already handle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def default_driver_memory() -> str:
    """60 % of physical memory, between 1 GB and 16 GB (local mode: the driver JVM
    is the whole executor)."""
    try:
        with open("/proc/meminfo") as f:
            kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal"))
        gb = int(kb / (1 << 20) * 0.6)
    except (OSError, StopIteration, ValueError):
        gb = 4
    return f"{max(1, min(16, gb))}g"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orrery", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:  # else Spark's default, coalesced by AQE
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("ORRERY_DRIVER_MEMORY", default_driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is a shared folder set by the operator of the cluster and is
    only read here; without one a cluster session is refused, because a folder of
    the driver's machine is not visible to the executors. Only a local session
    (one machine: tests, the bench) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="orrery-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def estimated_bytes(df) -> int:
    """Spark's estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured(df):
    """``df`` with a size that the planner knows: as it is if it has one (files, literal
    rows), else written as a table in the checkpoint folder and read back."""
    if estimated_bytes(df) < int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1)).rstrip("bB")):
        return df
    return written(df)


def written(df):
    """``df`` as a compressed table in the checkpoint folder: fewer bytes than a checkpoint.
    A frame that this function or ``cut_lineage`` returned is returned as is."""
    if getattr(df, "_orrery_written", False) or getattr(df, "_orrery_checkpointed", False):
        return df
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orrery-{spark.sparkContext.applicationId}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(path, compression="zstd")
    spark.sparkContext._jvm.System.gc()  # shuffle files that only led here can go
    out = spark.read.schema(df.schema).parquet(path)
    out._orrery_written = True
    return out


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (never localCheckpoint): survives executor loss.
    A frame this function returned is returned as is (no second write)."""
    if getattr(df, "_orrery_checkpointed", False):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=eager)
    out._orrery_checkpointed = True
    return out
