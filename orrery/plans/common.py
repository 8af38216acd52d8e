"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int) -> Column:
    """Round a double for engine-independent comparison (HALF_UP, as DuckDB)."""
    return F.round(_c(c).cast("double"), digits)


def r6(c) -> Column:
    return rnd(c, 6)


def rnd_half_up(c, digits: int) -> Column:
    """floor(x · 10^d + 0.5) / 10^d: the same IEEE arithmetic in every engine, so
    values that sit exactly on a decimal half round identically (``round`` does
    not: one engine rounds the decimal representation, another the binary value)."""
    scale = float(10 ** digits)
    return (F.floor(_c(c).cast("double") * scale + 0.5) / scale).cast("double")


def sql_half_up(expr: str, digits: int) -> str:
    """SQL twin of ``rnd_half_up``."""
    scale = 10 ** digits
    return f"CAST(floor(({expr}) * {scale}.0 + 0.5) / {scale}.0 AS DOUBLE)"
