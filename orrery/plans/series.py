"""Series group (survey 7.3): prices stand-in = daily mean ``o_totalprice`` per
``o_orderpriority`` from ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import timeseries as ts
from orrery.plans.common import r6, rnd, rnd_half_up, sql_half_up
from orrery.sources.tables import Tables

N_LAGS = 10
SPLIT_DAYS = 30


def prices(spark, sf):
    o = Tables(spark, sf).orders
    return ts.series_daily(o, "o_orderpriority", "o_orderdate", "o_totalprice",
                           out="close").withColumnRenamed("o_orderpriority", "series")


PRICES_SQL = """prices AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS close
  FROM orders GROUP BY 1, 2)"""


def scaled_split(spark, sf):
    """prices → 30-day split per series → min-max fitted on train rows.

    The series are daily aggregates, so a series has at most one row per calendar day."""
    p = ts.time_split(prices(spark, sf), "series", "date", SPLIT_DAYS)
    return ts.minmax_scale(p, "series", "close", out="x", fit_mask=F.col("split") == "train")


SCALED_SQL = PRICES_SQL + """,
s AS (SELECT *, CAST(max(date) OVER (PARTITION BY series) - INTERVAL 30 DAY AS DATE) AS threshold
      FROM prices),
s2 AS (SELECT *, CASE WHEN date <= threshold THEN 'train' ELSE 'test' END AS split FROM s),
sc AS (SELECT *, min(CASE WHEN split = 'train' THEN close END) OVER (PARTITION BY series) AS mn,
                 max(CASE WHEN split = 'train' THEN close END) OVER (PARTITION BY series) AS mx
       FROM s2),
z AS (SELECT *, CASE WHEN mx = mn THEN 0.5 ELSE (close - mn) / (mx - mn) END AS x FROM sc)"""


def _fcols(arr="features", n=N_LAGS):
    return [rnd(F.col(arr)[i], 6).alias(f"f{i}") for i in range(n)]


def q_series_daily(spark, sf):
    return prices(spark, sf).select("series", "date", rnd_half_up("close", 4).alias("close"))


def q_lag_features(spark, sf):
    lf = ts.lag_features(scaled_split(spark, sf), "series", "date", "x", N_LAGS)
    return lf.select("series", "date", "target_date", "split", *_fcols(),
                     rnd("label", 6).alias("label"))


def q_lag_features_prev(spark, sf):
    lf = ts.lag_features(scaled_split(spark, sf), "series", "date", "x", N_LAGS,
                         include_current=False)
    return lf.select("series", "date", "split", *_fcols(), rnd("label", 6).alias("label"))


def q_warmup_drop(spark, sf):
    return (ts.warmup_drop(prices(spark, sf), "series", "date", 10)
              .select("series", "date", rnd_half_up("close", 4).alias("close")))


def q_time_split(spark, sf):
    return ts.time_split(prices(spark, sf), "series", "date", SPLIT_DAYS).select(
        "series", "date", "threshold", "split")


def q_minmax_scale(spark, sf):
    s = ts.minmax_scale(prices(spark, sf), "series", "close", out="scaled")
    return s.select("series", "date", r6("scaled").alias("scaled"))


def q_inverse_scale(spark, sf):
    z = scaled_split(spark, sf)
    back = ts.inverse_scale(F.col("x"), F.col("scale_min"), F.col("scale_max"))
    return z.select("series", "date", rnd_half_up(back, 4).alias("close_back"),
                    rnd((back - F.col("close")), 6).alias("roundtrip_err"))


def q_latest_per_series(spark, sf):
    return ts.latest_per_series(prices(spark, sf), "series", "date", ["close"]).select(
        "series", "date", rnd_half_up("close", 4).alias("close"))


def q_append_forecast_row(spark, sf):
    return ts.append_forecast_row(prices(spark, sf), "series", "date", "close").select(
        "series", "date", rnd_half_up("close", 4).alias("close"))


def q_direction_label(spark, sf):
    from pyspark.sql import Window
    p = prices(spark, sf)
    w = Window.partitionBy("series").orderBy("date")
    chg = F.col("close") - F.lag("close", 1).over(w)
    return (p.withColumn("change", chg).filter(F.col("change").isNotNull())
             .select("series", "date", ts.direction_label(F.col("change")).alias("direction")))


def q_date_bounds(spark, sf):
    o = Tables(spark, sf).orders
    return o.agg(F.min(F.to_date("o_orderdate")).alias("min_date"),
                 F.max(F.to_date("o_orderdate")).alias("max_date"),
                 F.count(F.lit(1)).alias("n_rows"))


def q_nth_smallest(spark, sf):
    return ts.nth_smallest(prices(spark, sf), "series", "date", 10, out="nth_date")


QUERIES = {
    "series_daily": q_series_daily,
    "lag_features": q_lag_features,
    "lag_features_prev": q_lag_features_prev,
    "warmup_drop": q_warmup_drop,
    "nth_smallest": q_nth_smallest,
    "time_split": q_time_split,
    "minmax_scale": q_minmax_scale,
    "inverse_scale": q_inverse_scale,
    "latest_per_series": q_latest_per_series,
    "append_forecast_row": q_append_forecast_row,
    "direction_label": q_direction_label,
    "date_bounds": q_date_bounds,
}

_F_CUR = ", ".join(f"round(lag(x, {N_LAGS - 1 - i}) OVER w, 6) AS f{i}" for i in range(N_LAGS))
_F_PREV = ", ".join(f"round(lag(x, {N_LAGS - i}) OVER w, 6) AS f{i}" for i in range(N_LAGS))

ORACLE = {
    "series_daily": f"WITH {PRICES_SQL} SELECT series, date, {sql_half_up('close', 4)} AS close FROM prices",
    "lag_features": f"""WITH {SCALED_SQL},
l AS (SELECT series, date, split, lead(date) OVER w AS target_date, {_F_CUR},
             round(lead(x) OVER w, 6) AS label,
             count(x) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
      FROM z WINDOW w AS (PARTITION BY series ORDER BY date))
SELECT series, date, target_date, split, {", ".join(f"f{i}" for i in range(N_LAGS))}, label
FROM l WHERE n = 10 AND label IS NOT NULL""",
    "lag_features_prev": f"""WITH {SCALED_SQL},
l AS (SELECT series, date, split, {_F_PREV}, round(x, 6) AS label,
             count(x) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS n
      FROM z WINDOW w AS (PARTITION BY series ORDER BY date))
SELECT series, date, split, {", ".join(f"f{i}" for i in range(N_LAGS))}, label
FROM l WHERE n = 10 AND label IS NOT NULL""",
    "warmup_drop": f"""WITH {PRICES_SQL}
SELECT series, date, {sql_half_up('close', 4)} AS close FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM prices) WHERE rn > 10""",
    "nth_smallest": f"""WITH {PRICES_SQL}
SELECT series, date AS nth_date FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM prices) WHERE rn = 10""",
    "time_split": f"""WITH {PRICES_SQL},
s AS (SELECT *, CAST(max(date) OVER (PARTITION BY series) - INTERVAL 30 DAY AS DATE) AS threshold FROM prices)
SELECT series, date, threshold, CASE WHEN date <= threshold THEN 'train' ELSE 'test' END AS split FROM s""",
    "minmax_scale": f"""WITH {PRICES_SQL},
b AS (SELECT *, min(close) OVER (PARTITION BY series) AS mn, max(close) OVER (PARTITION BY series) AS mx FROM prices)
SELECT series, date, round(CASE WHEN mx = mn THEN 0.5 ELSE (close - mn) / (mx - mn) END, 6) AS scaled FROM b""",
    "inverse_scale": f"""WITH {SCALED_SQL}
SELECT series, date, {sql_half_up('mn + x * (mx - mn)', 4)} AS close_back,
       round((mn + x * (mx - mn)) - close, 6) + 0.0 AS roundtrip_err FROM z""",
    "latest_per_series": f"""WITH {PRICES_SQL}
SELECT series, max(date) AS date, {sql_half_up('arg_max(close, date)', 4)} AS close FROM prices GROUP BY series""",
    "append_forecast_row": f"""WITH {PRICES_SQL}
SELECT series, date, {sql_half_up('close', 4)} AS close FROM prices
UNION ALL
SELECT series, CAST(max(date) + INTERVAL 1 DAY AS DATE) AS date, CAST(NULL AS DOUBLE) AS close
FROM prices GROUP BY series""",
    "direction_label": f"""WITH {PRICES_SQL},
c AS (SELECT series, date, close - lag(close) OVER (PARTITION BY series ORDER BY date) AS change FROM prices)
SELECT series, date, CASE WHEN change > 0 THEN 'rises' WHEN change < 0 THEN 'falls' ELSE 'same' END AS direction
FROM c WHERE change IS NOT NULL""",
    "date_bounds": """SELECT CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date,
       count(*) AS n_rows FROM orders""",
}
