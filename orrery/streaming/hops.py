"""Structured Streaming version of the forecast pipeline (survey A7, A8, R1-R6).

Each hop is one streaming query with its own checkpoint folder inside the shared
checkpoint location (``spark.checkpoint.dir``), so a restarted or re-run query
resumes exactly where it stopped and file sinks stay exactly-once:

  R1  request topic → events          ``source`` + ``from_json``
  R2  enrich with daily sentiment      stream–static left join (static side aggregated);
                                       whole series per message: ``enriched_series``
  R3/R5 publish                        ``to_json(struct(...))`` as ``value`` to a sink
  R4  forecast per series              ``foreachBatch`` over the history so far
  R6  read predictions, direction      stateless select + ``direction_label``

R2 (whole series) and R4 keep the history as partial daily sums per epoch and compute
from all of it, so their result does not depend on how the events fall into micro-batches.

Tests and the registered queries use file sources with ``Trigger.AvailableNow``;
``fmt="kafka"`` switches the source to a broker topic when the Kafka connector is
on the classpath (it is not bundled here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators import forecast as fc
from orrery.operators import timeseries as ts
from orrery.sources.files import scratch_path


def source(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None,
           options: dict | None = None, max_files: int | None = None) -> DataFrame:
    """Streaming source: a folder of files (parquet / json) or a Kafka topic
    (``options`` = subscribe, kafka.bootstrap.servers …; value decoded as JSON)."""
    r = spark.readStream
    if fmt == "kafka":
        raw = r.format("kafka").options(**(options or {})).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")
    r = r.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def run_to_sink(df: DataFrame, sink: str | None, fmt: str = "parquet", checkpoint: str | None = None,
                output_mode: str = "append", options: dict | None = None) -> str | None:
    """Run a streaming query over everything available now, into a file sink, or with
    ``sink=None`` and ``options`` into another one (``fmt="kafka"``: kafka.bootstrap.servers,
    topic; the messages are the column ``value``)."""
    spark = df.sparkSession
    ck = checkpoint or scratch_path(spark, "stream-ckpt")
    w = (df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", ck)
           .options(**(options or {})).trigger(availableNow=True))
    (w.start(sink) if sink is not None else w.start()).awaitTermination()
    return sink


def publish(messages: DataFrame, path: str | None = None, fmt: str = "text", options: dict | None = None) -> None:
    """Write a batch of messages (column ``value``) to a folder or a topic, replacing what a
    folder holds."""
    w = messages.select("value").write.format(fmt).options(**(options or {}))
    (w.mode("overwrite").save(path) if path is not None else w.save())


def run_foreach_batch(df: DataFrame, fn, checkpoint: str | None = None) -> None:
    spark = df.sparkSession
    ck = checkpoint or scratch_path(spark, "stream-ckpt")
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", ck)
           .trigger(availableNow=True).start())
    q.awaitTermination()


# ---------------------------------------------------------------- hops

def ingest(events: DataFrame, payload_schema: str = "k int") -> DataFrame:
    """Event fields plus the decoded JSON payload."""
    p = F.from_json(F.col("props"), payload_schema)
    return events.select("event_id", "ts", "event_type", "value", p["k"].alias("k"))


def enrich(events: DataFrame, daily_static: DataFrame) -> DataFrame:
    """R2: stream–static LEFT join on the event day; the static side is already a
    daily aggregate (small per day, broadcast by AQE when small)."""
    e = events.select("event_id", "event_type", F.to_date("ts").alias("date"), "value")
    return e.join(daily_static, "date", "left")


def encode(df: DataFrame, cols: list[str]) -> DataFrame:
    """One JSON text per row as ``value`` (the message body)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))


def direction(messages: DataFrame, schema: str) -> DataFrame:
    """Decode prediction messages and label the direction of the change."""
    m = messages.select(F.from_json("value", schema).alias("m")).select("m.*")
    return m.withColumn("direction", ts.direction_label(F.col("prediction") - F.col("close")))


def add_to_history(history: str):
    """A function (batch, epoch) → the daily means of all events so far. The epoch's daily
    sums and counts are (over)written under the epoch, so a retried batch counts once."""
    def fn(batch: DataFrame, epoch_id: int) -> DataFrame:
        spark = batch.sparkSession
        part = (batch.filter(F.col("value").isNotNull()).groupBy("event_type", F.to_date("ts").alias("date"))
                     .agg(F.sum(F.col("value").cast("double")).alias("total"), F.count("value").alias("n")))
        part.write.mode("overwrite").parquet(f"{history}/epoch={epoch_id}")
        return (spark.read.option("basePath", history).parquet(history).groupBy("event_type", "date")
                     .agg((F.sum("total") / F.sum("n")).alias("close")))

    return fn


def enriched_series(daily: DataFrame, daily_static: DataFrame) -> DataFrame:
    """One message per series: its whole daily history with the day's sentiment."""
    j = daily.join(daily_static, "date", "left")
    days = F.sort_array(F.collect_list(F.struct("date", "close", "avg_sentiment")))  # bounded by the calendar
    return j.groupBy("event_type").agg(days.alias("history")).select(F.to_json(F.struct(F.col("event_type").alias("stock"), "history")).alias("value"))


def forecast_series(daily: DataFrame, n_lags: int = 10, seed: int = 42) -> DataFrame | None:
    """Per series the forecast of the day after its last one: a placeholder row is
    appended, the streaming lag layout (10 previous values, label = current) built, a decision
    tree fitted on the complete rows and the placeholders predicted. None without a complete row."""
    from pyspark.ml.regression import DecisionTreeRegressor

    full = ts.append_forecast_row(daily, "event_type", "date", "close")
    lf = fc.with_vector(ts.lag_features(full, "event_type", "date", "close", n_lags, include_current=False, keep_null_label=True))
    train = lf.filter(F.col("label").isNotNull())
    if train.isEmpty():
        return None
    model = DecisionTreeRegressor(featuresCol="fv", labelCol="label", seed=seed).fit(train)
    last = ts.latest_per_series(daily, "event_type", "date", ["close"]).select("event_type", F.col("date").alias("prev_date"), "close")
    return model.transform(lf.filter(F.col("label").isNull())).select("event_type", "date", "prediction").join(last, "event_type")


def prediction_messages(forecast: DataFrame) -> DataFrame:
    """``{Date, Prediction, Prev_date, Close, Stock Name}`` per series."""
    return forecast.select(F.to_json(F.struct(
        F.col("date").alias("Date"), F.col("prediction").alias("Prediction"), F.col("prev_date").alias("Prev_date"),
        F.col("close").alias("Close"), F.col("event_type").alias("Stock Name"))).alias("value"))


def forecast_batch(history: str, messages: str | None, fmt: str = "text", options: dict | None = None, n_lags: int = 10, seed: int = 42):
    """A ``foreachBatch`` function: add the batch to the history, forecast every series
    from it and publish the messages; a folder holds those of the last batch."""
    add = add_to_history(history)

    def fn(batch: DataFrame, epoch_id: int) -> None:
        out = forecast_series(add(batch, epoch_id), n_lags, seed)
        if out is not None:
            publish(prediction_messages(out), messages, fmt, options)

    return fn


def enrich_batch(history: str, daily_static: DataFrame, messages: str | None, fmt: str = "text", options: dict | None = None):
    """A ``foreachBatch`` function: add the batch to the history and publish every
    series with its sentiment."""
    add = add_to_history(history)

    def fn(batch: DataFrame, epoch_id: int) -> None:
        publish(enriched_series(add(batch, epoch_id), daily_static), messages, fmt, options)

    return fn
