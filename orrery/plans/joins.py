"""Join group: short daily series from events (5 event types × 30 days) joined to
the daily document sentiment (survey C1-C4, C7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import timeseries as ts
from orrery.operators.scalar_join import attach_scalar
from orrery.plans.common import rnd
from orrery.plans.text import SCORED_SQL, daily_sentiment
from orrery.sources.tables import Tables


def event_prices(spark, sf):
    e = Tables(spark, sf).events
    return ts.series_daily(e, "event_type", "ts", "value", out="close").withColumnRenamed(
        "event_type", "series")


EV_SQL = """ev AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, avg(value) AS close
  FROM events GROUP BY 1, 2)"""
DS_SQL = "ds AS (SELECT date, avg(compound) AS avg_sentiment FROM scored GROUP BY date)"


def q_price_sentiment_left(spark, sf):
    p = event_prices(spark, sf)
    s = daily_sentiment(spark, sf).select("date", "avg_sentiment")
    return p.join(s, "date", "left").select("series", "date", rnd("close", 6).alias("close"),
                                            rnd("avg_sentiment", 6).alias("avg_sentiment"))


def q_price_sentiment_inner(spark, sf):
    p = event_prices(spark, sf)
    s = daily_sentiment(spark, sf).select(F.col("date").alias("sent_date"), "avg_sentiment")
    j = p.join(s, p["date"] == s["sent_date"], "inner")
    return j.select("series", "date", "sent_date", rnd("close", 6).alias("close"),
                    rnd("avg_sentiment", 6).alias("avg_sentiment"))


def q_pred_actual_join(spark, sf):
    """Keyed predictions (mean of the last 10 days, for ``target_date``) joined to
    the actual value of that day on (series, date) — no positional zip."""
    p = event_prices(spark, sf)
    lf = ts.lag_features(p, "series", "date", "close", 10)
    pred = lf.select("series", F.col("target_date").alias("date"),
                     F.aggregate("features", F.lit(0.0), lambda a, b: a + b).alias("_s"))
    pred = pred.select("series", "date", (F.col("_s") / 10).alias("prediction"))
    j = pred.join(p, ["series", "date"])
    return j.select("series", "date", rnd("prediction", 6).alias("prediction"),
                    rnd("close", 6).alias("actual"), rnd(F.col("prediction") - F.col("close"), 6).alias("error"))


def q_crossjoin_scalar(spark, sf):
    p = event_prices(spark, sf)
    one = p.agg(F.max("date").alias("last_date"), F.avg("close").alias("grand_mean"))
    j = attach_scalar(p, one)
    return j.select("series", "date", "last_date", F.datediff("last_date", "date").alias("days_to_end"),
                    rnd(F.col("close") - F.col("grand_mean"), 6).alias("centered"))


QUERIES = {
    "price_sentiment_left": q_price_sentiment_left,
    "price_sentiment_inner": q_price_sentiment_inner,
    "pred_actual_join": q_pred_actual_join,
    "crossjoin_scalar": q_crossjoin_scalar,
}

ORACLE = {
    "price_sentiment_left": f"""WITH {SCORED_SQL}, {EV_SQL}, {DS_SQL}
SELECT series, ev.date, round(close, 6) AS close, round(avg_sentiment, 6) AS avg_sentiment
FROM ev LEFT JOIN ds ON ev.date = ds.date""",
    "price_sentiment_inner": f"""WITH {SCORED_SQL}, {EV_SQL}, {DS_SQL}
SELECT series, ev.date, ds.date AS sent_date, round(close, 6) AS close, round(avg_sentiment, 6) AS avg_sentiment
FROM ev JOIN ds ON ev.date = ds.date""",
    "pred_actual_join": f"""WITH {EV_SQL},
l AS (SELECT series, date, lead(date) OVER w AS target_date, lead(close) OVER w AS nxt,
        sum(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s,
        count(close) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
      FROM ev WINDOW w AS (PARTITION BY series ORDER BY date)),
p AS (SELECT series, target_date AS date, s / 10 AS prediction FROM l WHERE n = 10 AND nxt IS NOT NULL)
SELECT p.series, p.date, round(prediction, 6) AS prediction, round(close, 6) AS actual,
  round(prediction - close, 6) AS error FROM p JOIN ev ON p.series = ev.series AND p.date = ev.date""",
    "crossjoin_scalar": f"""WITH {EV_SQL}, one AS (SELECT max(date) AS last_date, avg(close) AS grand_mean FROM ev)
SELECT series, date, last_date, CAST(datediff('day', date, last_date) AS INTEGER) AS days_to_end,
  round(close - grand_mean, 6) AS centered FROM ev, one""",
}
