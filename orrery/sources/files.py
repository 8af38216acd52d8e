"""File sources and sinks (survey A1-A3, A5, A6, A9, A10).

Schemas are always explicit: inference costs an extra pass over the data and
gives different types on different samples.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orrery.session import ensure_checkpoint_dir


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             header: bool = True, multiline: bool = False, trim: bool = True) -> DataFrame:
    """CSV scan: header, optional multi-line records, trimmed whitespace (A1-A3).

    Multi-line CSV cannot be split inside a file, so ``multiline=True`` is for
    many moderately sized files; single-line CSV splits at any byte offset.
    """
    return (spark.read.schema(schema)
            .option("header", header).option("sep", sep)
            .option("multiLine", multiline)
            .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False) -> DataFrame:
    """JSON lines (or whole-file JSON documents with ``multiline``) with an explicit
    schema; nested arrays of structs are then flattened with ``explode`` (A5)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the shared checkpoint folder (never a machine-local
    temporary folder on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def rows_to_frame(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """Literal rows → DataFrame (A9): only for small parameter tables (scenarios,
    lexicons), never for data."""
    return spark.createDataFrame(rows, schema)
