"""Daily series, lag windows, labels, time splits, scaling (survey 2.5, 2.7 G6, M2, H11).

Every window is partitioned by the series key, so each series is an independent
task and the windows never funnel a whole table into one partition. The windows run
on *daily* rows (one row per series and day, produced by a partial + final
aggregation), so a window partition is bounded by the calendar, not by the raw
row count: even a series holding a third of all raw rows is a few thousand daily
rows after the map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.columns import direction_label, inverse_scale  # noqa: F401

from orrery.operators.scalar_join import attach_scalar


def series_daily(df: DataFrame, series: str, ts: str, value: str, out: str = "close",
                 how: str = "avg") -> DataFrame:
    """One row per (series, day): the daily mean (or other aggregate) of ``value``."""
    last = lambda c: F.max_by(c, "_ts")  # noqa: E731  the value at the latest time
    agg = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "last": last}[how]
    return (df.select(F.col(series).alias(series), F.to_date(F.col(ts)).alias("date"), F.col(ts).alias("_ts"),
                      F.col(value).cast("double").alias(value))
              .groupBy(series, "date")
              .agg(agg(value).alias(out)))


def _w(series: str | list[str], date: str):
    keys = [series] if isinstance(series, str) else list(series)
    return Window.partitionBy(*keys).orderBy(date)


def lag_features(df: DataFrame, series: str, date: str, value: str, n_lags: int = 10,
                 include_current: bool = True, out: str = "features",
                 label: str = "label", extra: list[str] | None = None,
                 keep_null_label: bool = False) -> DataFrame:
    """Trailing list of ``n_lags`` values and a label.

    ``include_current=True`` (batch layout): frame rows -(n-1)..0 and the label is the
    *next* row's value (``lead``); the row also carries ``target_date``, the date the
    label belongs to. ``include_current=False`` (streaming layout): frame rows -n..-1
    and the label is the current value.

    ``collect_list`` skips nulls, so requiring ``size == n`` also drops windows with a
    missing value. ``extra`` columns (e.g. a sentiment score) are appended after the
    lags for the current row, so the features array has ``n_lags + len(extra)``
    entries (a null extra value still counts as an entry, as ``array(NULL)`` does).
    ``keep_null_label`` keeps rows whose label is missing (rows to be forecast).

    Rows of a series are ordered by ``date``, unique within a series; a null series is
    one. The input is one row per series and day (``series_daily``), so a window
    partition is bounded by the calendar whatever the raw volume of a series.
    """
    w = _w(series, date)
    if include_current:
        frame = w.rowsBetween(-(n_lags - 1), 0)
        lab = F.lead(value, 1).over(w)
        tdate = F.lead(date, 1).over(w)
    else:
        frame = w.rowsBetween(-n_lags, -1)
        lab = F.col(value)
        tdate = F.col(date)
    lags = F.collect_list(F.col(value)).over(frame)
    out_df = (df.withColumn("_lags", lags)
                .withColumn(label, lab.cast("double"))
                .withColumn("target_date", tdate))
    feats = F.col("_lags")
    if extra:
        feats = F.concat(feats, F.array(*[F.col(c).cast("double") for c in extra]))
    out_df = out_df.filter(F.size("_lags") == n_lags)
    if not keep_null_label:
        out_df = out_df.filter(F.col(label).isNotNull())
    return out_df.withColumn(out, feats).drop("_lags")


def warmup_drop(df: DataFrame, series: str, date: str, k: int = 10) -> DataFrame:
    """Drop the first ``k`` rows of each series (dates after the k-th smallest)."""
    w = _w(series, date)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > k).drop("_rn")


def nth_smallest(df: DataFrame, series: str, date: str, n: int, out: str = "nth_date") -> DataFrame:
    """n-th smallest ``date`` per series."""
    w = _w(series, date)
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n)
              .select(series, F.col(date).alias(out)))


def time_split(df: DataFrame, series: str, date: str, days: int = 30,
               out: str = "split", per_series: bool = True, as_of=None) -> DataFrame:
    """Label rows 'train' (date <= max(date) - days) or 'test'. With ``as_of`` (a date or
    column, such as ``current_date()``) the days count back from it instead of the last date.

    The threshold day itself is in train. ``per_series`` takes the max per series
    (a window on the series partitioning the caller already has); otherwise the
    global max, obtained by a one-row aggregate joined back (no collect).
    """
    if as_of is not None:
        with_max = df.withColumn("_max_date", (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date"))
    elif per_series:
        mx = F.max(F.col(date)).over(Window.partitionBy(series))
        with_max = df.withColumn("_max_date", mx)
    else:
        with_max = attach_scalar(df, df.agg(F.max(date).alias("_max_date")))
    thr = F.date_sub(F.col("_max_date"), days)
    return (with_max.withColumn("threshold", thr)
                    .withColumn(out, F.when(F.col(date) <= F.col("threshold"), F.lit("train"))
                                      .otherwise(F.lit("test")))
                    .drop("_max_date"))


def minmax_scale(df: DataFrame, series: str | None, value: str, out: str | None = None,
                 fit_mask: Column | None = None) -> DataFrame:
    """Per-series min-max scaling to [0, 1]; a constant series scales to 0.5.

    ``fit_mask`` restricts the rows the min/max are fitted on (e.g. train rows only,
    to avoid leaking the test period); None fits on all rows. The fitted bounds
    stay on every row as ``scale_min``/``scale_max`` so ``inverse_scale`` can undo it.
    """
    out = out or f"scaled_{value}"
    v = F.col(value)
    fit_v = v if fit_mask is None else F.when(fit_mask, v)
    w = Window.partitionBy(series) if series else Window.partitionBy()
    if series is None:
        res = attach_scalar(df, df.agg(F.min(fit_v).alias("scale_min"),
                                       F.max(fit_v).alias("scale_max")))
    else:
        res = (df.withColumn("scale_min", F.min(fit_v).over(w))
                 .withColumn("scale_max", F.max(fit_v).over(w)))
    rng = F.col("scale_max") - F.col("scale_min")
    return res.withColumn(out, F.when(rng == 0, F.lit(0.5))
                                .otherwise((v - F.col("scale_min")) / rng))


def latest_per_series(df: DataFrame, series: str, date: str, cols: list[str]) -> DataFrame:
    """Top-1 row per series by date, as a one-pass ``max_by`` aggregate."""
    packed = F.struct(*[F.col(c) for c in [date] + cols])
    return (df.groupBy(series).agg(F.max_by(packed, F.col(date)).alias("_r"))
              .select(series, *[F.col("_r")[c].alias(c) for c in [date] + cols]))


def append_forecast_row(df: DataFrame, series: str, date: str, value: str) -> DataFrame:
    """Append, per series, a placeholder row for the day after the last date with a
    NULL value (the row to be forecast). NULL keeps it out of any fit."""
    nxt = (df.groupBy(series).agg(F.date_add(F.max(date), 1).alias(date))
             .withColumn(value, F.lit(None).cast("double")))
    return df.unionByName(nxt, allowMissingColumns=True)

