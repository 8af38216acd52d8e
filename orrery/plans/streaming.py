"""Streaming group: ``events`` as a file stream (AvailableNow) through the hops of
the real-time pipeline; each returns the final sink table read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.plans.common import rnd
from orrery.plans.text import SCORED_SQL, daily_sentiment
from orrery.sources.files import scratch_path
from orrery.streaming import hops as sp

PRED_SCHEMA = "stock string, date date, prediction double, close double"


def event_stream(spark, sf, max_files=None):
    path = f"{sf}/events.parquet"  # one file or a folder of files
    # as a pattern, because a plain path of a file source must be a folder
    return sp.source(spark, f"{sf}/event[s].parquet", spark.read.parquet(path).schema, "parquet", max_files=max_files)


def q_stream_ingest(spark, sf):
    sink = scratch_path(spark, "stream_ingest")
    sp.run_to_sink(sp.ingest(event_stream(spark, sf)), sink)
    return spark.read.parquet(sink).select("event_id", "ts", "event_type", rnd("value", 6).alias("value"), "k")


def q_stream_enrich(spark, sf):
    sink = scratch_path(spark, "stream_enrich")
    static = daily_sentiment(spark, sf).select("date", "avg_sentiment")
    sp.run_to_sink(sp.enrich(event_stream(spark, sf), static), sink)
    return spark.read.parquet(sink).select("event_id", "event_type", "date", rnd("value", 6).alias("value"),
                                           rnd("avg_sentiment", 6).alias("avg_sentiment"))


def q_stream_direction(spark, sf):
    """events → prediction messages (JSON text sink) → second stream decodes them
    and labels the direction (prediction = value, close = payload k)."""
    ev = sp.ingest(event_stream(spark, sf)).select(
        F.col("event_type").alias("stock"), F.to_date("ts").alias("date"),
        F.col("value").alias("prediction"), F.col("k").cast("double").alias("close"), "event_id")
    msgs = scratch_path(spark, "stream_messages")
    sp.run_to_sink(sp.encode(ev, ["event_id", "stock", "date", "prediction", "close"]), msgs, fmt="text")
    schema = "event_id long, " + PRED_SCHEMA
    text = spark.readStream.schema("value string").text(msgs)
    out = scratch_path(spark, "stream_direction")
    sp.run_to_sink(sp.direction(text, schema), out)
    return spark.read.parquet(out).select("event_id", "stock", "date", "direction")


MESSAGE_SCHEMA = "Date date, Prediction double, Prev_date date, Close double, `Stock Name` string"
SERIES_SCHEMA = "stock string, history array<struct<date: date, close: double, avg_sentiment: double>>"


def decoded(spark, path, schema):
    return spark.read.text(path).select(F.from_json("value", schema).alias("m")).select("m.*")


def q_stream_forecast(spark, sf, max_files=None):
    """events → forecast per series → prediction messages, decoded."""
    messages = scratch_path(spark, "stream_forecast")
    sp.run_foreach_batch(event_stream(spark, sf, max_files), sp.forecast_batch(scratch_path(spark, "history"), messages))
    return decoded(spark, messages, MESSAGE_SCHEMA).select(
        F.col("Stock Name").alias("event_type"), F.col("Date").alias("date"), F.col("Prev_date").alias("prev_date"),
        rnd("Close", 6).alias("close"), rnd("Prediction", 6).alias("prediction"))


def q_stream_series(spark, sf, max_files=None):
    """events → whole enriched series per message, decoded: one row per series and day."""
    messages = scratch_path(spark, "stream_series")
    static = daily_sentiment(spark, sf).select("date", "avg_sentiment")
    sp.run_foreach_batch(event_stream(spark, sf, max_files), sp.enrich_batch(scratch_path(spark, "history"), static, messages))
    d = decoded(spark, messages, SERIES_SCHEMA).select("stock", F.explode("history").alias("d"))
    return d.select("stock", "d.date", rnd("d.close", 6).alias("close"), rnd("d.avg_sentiment", 6).alias("avg_sentiment"))


QUERIES = {
    "stream_ingest": q_stream_ingest,
    "stream_enrich": q_stream_enrich,
    "stream_direction": q_stream_direction,
    "stream_forecast": q_stream_forecast,
    "stream_series": q_stream_series,
}

ORACLE = {
    "stream_ingest": """SELECT event_id, ts, event_type, round(value, 6) AS value,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "stream_enrich": f"""WITH {SCORED_SQL},
ds AS (SELECT date, avg(compound) AS avg_sentiment FROM scored GROUP BY date)
SELECT event_id, event_type, CAST(ts AS DATE) AS date, round(value, 6) AS value, round(avg_sentiment, 6) AS avg_sentiment
FROM events LEFT JOIN ds ON CAST(ts AS DATE) = ds.date""",
    "stream_series": f"""WITH {SCORED_SQL},
ds AS (SELECT date, avg(compound) AS avg_sentiment FROM scored GROUP BY date),
p AS (SELECT event_type AS stock, CAST(ts AS DATE) AS date, avg(value) AS close FROM events WHERE value IS NOT NULL GROUP BY ALL)
SELECT stock, p.date, round(close, 6) AS close, round(avg_sentiment, 6) AS avg_sentiment FROM p LEFT JOIN ds ON p.date = ds.date""",
    "stream_direction": """SELECT event_id, event_type AS stock, CAST(ts AS DATE) AS date,
  CASE WHEN value - CAST(json_extract(props, '$.k') AS DOUBLE) > 0 THEN 'rises'
       WHEN value - CAST(json_extract(props, '$.k') AS DOUBLE) < 0 THEN 'falls' ELSE 'same' END AS direction
FROM events""",
}
