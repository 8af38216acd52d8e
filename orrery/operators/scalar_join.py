"""Attaching one-row results (a global max, fitted bounds, a scalar) to every row.

The one-row aggregate is computed first (a grouping-free aggregate: exactly one
row, so its size is bounded by construction) and its values are added to ``df``
as typed literals — the way a fitted scaler applies its statistics. No join, no
cross product: the consumer stays a narrow projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a grouping-free aggregate to every row of ``df``."""
    row = one_row.first()  # one row by construction
    cols = [F.lit(None if row is None else row[f.name]).cast(f.dataType).alias(f.name)
            for f in one_row.schema.fields]
    return df.select("*", *cols)
