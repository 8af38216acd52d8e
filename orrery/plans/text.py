"""Text group: documents (dated as 2024-01-01 + doc_id % 30), conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import text as tx
from orrery.operators import timeseries as ts
from orrery.plans.common import rnd
from orrery.sources.tables import Tables

# The stand-in lexicon (token, valence). The tokens are frequent words
# of the test documents; the valences are invented for the tests.
LEXICON = [
    ("the", 0.1), ("of", -0.1), ("and", 0.3), ("to", 0.2), ("in", -0.2),
    ("that", 1.5), ("with", 0.8), ("this", -0.7), ("from", 0.5), ("tion", -1.2),
    ("ther", 1.1), ("than", -0.9), ("pour", 2.0), ("de", 0.05), ("la", -0.3),
    ("der", 0.4), ("die", -2.1), ("und", 0.6), ("que", -0.5), ("les", 0.25),
]
# Stand-in modifiers (token, boost, negates), words of the test documents.
MODIFIERS = [
    ("not", 0.0, True), ("no", 0.0, True), ("nicht", 0.0, True), ("pas", 0.0, True), ("nie", 0.0, True),
    ("is", 0.293, False), ("ist", 0.293, False), ("est", 0.293, False), ("es", 0.293, False),
    ("on", -0.293, False), ("as", -0.293, False), ("en", -0.293, False), ("the", 0.293, False),
]
ORIGIN = "2024-01-01"
NEWS_ITEM = "turn: bigint, role: string, text: string"
FEED_CHUNK = 64  # feed messages carry at most this many items


def lexicon_df(spark):
    rows = ", ".join(f"('{t}', {v}D)" for t, v in LEXICON)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(token, valence)")  # literal rows: their size is known


def modifiers_df(spark):
    rows = ", ".join(f"('{t}', {b}D, {str(n).lower()})" for t, b, n in MODIFIERS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS modifiers(token, boost, negates)")


def rule_scored_docs(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    return tx.rule_sentiment(d, "text", lexicon_df(spark), modifiers_df(spark), id_col="doc_id")


def scored_docs(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "text")
    s = tx.lexicon_sentiment(d, "text", lexicon_df(spark), id_col="doc_id")
    return s.withColumn("date", F.date_add(F.lit(ORIGIN).cast("date"), (F.col("doc_id") % 30).cast("int")))


def daily_sentiment(spark, sf):
    return tx.daily_mean(scored_docs(spark, sf), "date", "compound")


def q_text_contains(spark, sf):
    from orrery.operators.relational import contains_filter
    d = Tables(spark, sf).documents.select("doc_id", "lang", "text")
    kept = contains_filter(contains_filter(d, "text", "the"), "text", "http", negate=True)
    return kept.select("doc_id", "lang")


def q_lexicon_sentiment(spark, sf):
    return scored_docs(spark, sf).select("doc_id", rnd("compound", 6).alias("compound"))


def q_rule_sentiment(spark, sf):
    return rule_scored_docs(spark, sf).select("doc_id", rnd("compound", 6).alias("compound"))


def q_sentiment_bucket(spark, sf):
    s = scored_docs(spark, sf)
    return s.select("doc_id", rnd("compound", 6).alias("compound"),
                    tx.sentiment_bucket("compound").alias("bucket"),
                    tx.sentiment_bucket("compound", strict=True).alias("bucket_strict"))


def q_daily_sentiment(spark, sf):
    return daily_sentiment(spark, sf).select("date", rnd("avg_sentiment", 6).alias("avg_sentiment"),
                                             "n_docs")


def q_feed_explode(spark, sf):
    """conversations → feed messages (JSON, at most FEED_CHUNK items each) → parsed
    and exploded back to one row per item."""
    c = Tables(spark, sf).conversations
    msgs = (c.groupBy("conv_id", (F.col("turn") / FEED_CHUNK).cast("long").alias("chunk"))
             .agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role", "text")).alias("feed")))
                  .alias("value")))
    return (msgs.select("conv_id", F.explode(tx.feed_rows("value", NEWS_ITEM)).alias("item"))
                .select("conv_id", "item.turn", "item.role", "item.text"))


def q_json_encode(spark, sf):
    """Latest daily row per priority series → JSON message text."""
    from orrery.plans.series import prices
    last = ts.latest_per_series(prices(spark, sf), "series", "date", ["close"])
    last = last.withColumn("close", rnd("close", 2))
    return last.select("series", tx.to_json_value("series", "date", "close").alias("value"))


def q_timestamp_parse(spark, sf):
    """events.ts rendered as tweet text and as compact news text, parsed back."""
    e = Tables(spark, sf).events.select("event_id", "ts")
    t = e.withColumn("tweet", F.date_format("ts", "EEE MMM dd HH:mm:ss +0000 yyyy")) \
         .withColumn("news", F.date_format("ts", "yyyyMMdd'T'HHmmss"))
    return t.select("event_id", tx.parse_tweet_time("tweet").alias("tweet_ts"),
                    tx.parse_compact_time("news").alias("news_ts"),
                    F.to_date(tx.parse_compact_time("news")).alias("news_date"),
                    F.unix_timestamp(tx.parse_compact_time("news")).alias("epoch"))


def q_epoch_text(spark, sf):
    """events.ts → epoch seconds → text → epoch seconds."""
    e = Tables(spark, sf).events.select("event_id", F.unix_timestamp("ts").alias("epoch"))
    t = e.withColumn("text", F.from_unixtime("epoch", "yyyy-MM-dd HH:mm:ss"))
    return t.withColumn("back", F.unix_timestamp("text", "yyyy-MM-dd HH:mm:ss"))


QUERIES = {
    "epoch_text": q_epoch_text,
    "text_contains": q_text_contains,
    "lexicon_sentiment": q_lexicon_sentiment,
    "rule_sentiment": q_rule_sentiment,
    "sentiment_bucket": q_sentiment_bucket,
    "daily_sentiment": q_daily_sentiment,
    "feed_explode": q_feed_explode,
    "json_encode": q_json_encode,
    "timestamp_parse": q_timestamp_parse,
}

LEX_SQL = "lex(token, valence) AS (VALUES " + ", ".join(f"('{t}', {v})" for t, v in LEXICON) + ")"
SCORED_SQL = LEX_SQL + r""",
tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS token FROM documents),
s AS (SELECT tok.doc_id, round(sum(lex.valence), 9) AS s FROM tok JOIN lex USING (token) GROUP BY tok.doc_id),
scored AS (SELECT d.doc_id, CAST(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER) AS DATE) AS date,
  CASE WHEN coalesce(s.s, 0) = 0 THEN 0.0 ELSE s.s / sqrt(s.s * s.s + 15.0) END AS compound
  FROM documents d LEFT JOIN s USING (doc_id))"""

ORACLE = {
    "text_contains": "SELECT doc_id, lang FROM documents WHERE contains(text, 'the') AND NOT contains(text, 'http')",
    "lexicon_sentiment": f"WITH {SCORED_SQL} SELECT doc_id, round(compound, 6) AS compound FROM scored",
    "sentiment_bucket": f"""WITH {SCORED_SQL}
SELECT doc_id, round(compound, 6) AS compound,
  CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS bucket,
  CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative'
       WHEN compound = 0 THEN 'neutral' END AS bucket_strict
FROM scored""",
    "daily_sentiment": f"""WITH {SCORED_SQL}
SELECT date, round(avg(compound), 6) AS avg_sentiment, count(*) AS n_docs FROM scored GROUP BY date""",
    "feed_explode": "SELECT conv_id, turn, role, text FROM conversations",
    "json_encode": """WITH p AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date,
  avg(o_totalprice) AS close FROM orders GROUP BY 1, 2),
l AS (SELECT series, max(date) AS date, round(arg_max(close, date), 2) AS close FROM p GROUP BY series)
SELECT series, CAST(to_json({'series': series, 'date': date, 'close': close}) AS VARCHAR) AS value FROM l""",
    "epoch_text": """SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS back FROM events""",
    "timestamp_parse": """SELECT event_id, date_trunc('second', ts) AS tweet_ts, date_trunc('second', ts) AS news_ts,
  CAST(ts AS DATE) AS news_date, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch FROM events""",
}

MOD_SQL = "mods(token, boost, neg) AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}', {b}, {int(n)})" for t, b, n in MODIFIERS) + (
    ") v(token, boost, neg) WHERE token NOT IN (SELECT token FROM lex))")
ORACLE["rule_sentiment"] = rf"""WITH {LEX_SQL}, {MOD_SQL},
tok AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS pos FROM tok),
h AS (SELECT p.doc_id, p.pos, lex.valence AS v FROM p JOIN lex USING (token)),
q AS (SELECT p.doc_id, p.pos, mods.boost, mods.neg FROM p JOIN mods USING (token)),
m AS (SELECT h.doc_id, h.pos, any_value(h.v) AS v, sum(coalesce(q.boost, 0) * CASE h.pos - q.pos WHEN 1 THEN 1.0 WHEN 2 THEN 0.95 ELSE 0.9 END) AS b,
  sum(coalesce(q.neg, 0)) AS n FROM h LEFT JOIN q ON q.doc_id = h.doc_id AND q.pos BETWEEN h.pos - 3 AND h.pos - 1 GROUP BY 1, 2),
s AS (SELECT doc_id, round(sum((v + sign(v) * coalesce(b, 0)) * pow(-0.74, n)), 9) AS s FROM m GROUP BY 1)
SELECT d.doc_id, round(CASE WHEN coalesce(s.s, 0) = 0 THEN 0.0 ELSE s.s / sqrt(s.s * s.s + 15.0) END, 6) AS compound
FROM documents d LEFT JOIN s USING (doc_id)"""
