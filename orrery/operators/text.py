"""Text operators (survey B2, B10, D1, A5, A8, H1-H4, H10, M35).

Lexicon sentiment replaces a per-row Python analyzer with native expressions: the
text is lower-cased and split on non-letters, each token is looked up in the
lexicon and the valence sum ``s`` is normalised to ``s / sqrt(s^2 + alpha)`` with
alpha = 15 (the published VADER normalisation). ``rule_sentiment`` also applies negators
and boosters before a word. Whole texts are always scored, never a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.columns import TOKEN_SPLIT, VADER_ALPHA, feed_rows, normalise, parse_compact_time, parse_tweet_time, sentiment_bucket, to_json_value, tokens  # noqa: F401
from orrery.session import measured


def lexicon_sentiment(df: DataFrame, text: str, lexicon: DataFrame, id_col: str,
                      token_col: str = "token", valence_col: str = "valence", out: str = "compound",
                      alpha: float = VADER_ALPHA) -> DataFrame:
    """Add ``out`` (compound score in [-1, 1]) to every row of ``df`` (``id_col``
    unique).

    Tokens are exploded and left-joined to the lexicon: of such a join Spark can only
    broadcast the lexicon, and does so if its measured size allows (a lexicon of unknown
    size is written as a table first). Valences get a partial sum per row before the
    shuffle; the sums are left-joined back, so rows without a lexicon token score 0.
    """
    lex = measured(lexicon.select(F.col(token_col).alias("_tok"), F.col(valence_col).cast("double").alias("_val")))
    # empty tokens (text starting with a non-letter) never match a lexicon entry
    tok = df.select(F.col(id_col).alias("_id"), F.explode(F.split(F.lower(F.col(text)), TOKEN_SPLIT)).alias("_tok"))
    s = tok.join(lex, "_tok", "left").groupBy("_id").agg(F.sum("_val").alias("_s"))
    return (df.join(s.withColumnRenamed("_id", id_col), id_col, "left")
              .withColumn(out, normalise(F.coalesce(F.col("_s"), F.lit(0.0)), alpha)).drop("_s"))


# Published VADER constants. A booster counts fully right before the word,
# less two and three tokens before; each negator among the three turns and weakens.
BOOST_BY_DISTANCE = (1.0, 0.95, 0.9)
NEGATION = -0.74


def rule_sentiment(df: DataFrame, text: str, lexicon: DataFrame, modifiers: DataFrame, id_col: str,
                   out: str = "compound", alpha: float = VADER_ALPHA) -> DataFrame:
    """``lexicon_sentiment`` with negators and boosters: adds ``out`` to every row of ``df``.

    ``modifiers`` is (token, boost, negates): a booster moves the valence of a lexicon word up
    to three tokens after it by ``boost`` away from zero (negative: towards it), times
    BOOST_BY_DISTANCE; a negator multiplies it by NEGATION. Modifiers that are lexicon words
    themselves count as such only, a word's valence of 0 stays 0. A token listed twice in a
    table counts with the sum of its entries (negates: any).

    Every token carries the three before it, so the window is a join of positions within a row
    and needs no shuffle or sort of tokens; both tables have a known size and are the build
    sides. Null or empty text scores 0.
    """
    lex = measured(lexicon.groupBy(F.col("token").alias("_tok")).agg(F.sum(F.col("valence").cast("double")).alias("_val")))
    mods = measured(modifiers.groupBy(F.col("token").alias("_m")).agg(F.sum(F.col("boost").cast("double")).alias("_boost"),
                                                                      F.max(F.col("negates").cast("int")).alias("_neg"))
                    .join(lex, F.col("_m") == F.col("_tok"), "left_anti"))
    before = range(1, len(BOOST_BY_DISTANCE) + 1)
    words = df.select(F.col(id_col).alias("_id"), tokens(text).alias("_w"))
    near = F.transform("_w", lambda x, i: F.struct(x.alias("_tok"), *[F.get("_w", i - d).alias(f"_t{d}") for d in before]))
    tok = words.select("_id", F.explode(near).alias("_x")).select("_id", "_x.*").join(lex, "_tok", "left")
    for d in before:
        m = mods.select(F.col("_m").alias(f"_t{d}"), F.col("_boost").alias(f"_b{d}"), F.col("_neg").alias(f"_n{d}"))
        # only a lexicon word looks its predecessors up
        tok = tok.withColumn(f"_t{d}", F.when(F.col("_val").isNotNull(), F.col(f"_t{d}"))).join(m, f"_t{d}", "left")
    boost = sum((F.coalesce(F.col(f"_b{d}"), F.lit(0.0)) * BOOST_BY_DISTANCE[d - 1] for d in before), F.lit(0.0))
    turns = sum((F.coalesce(F.col(f"_n{d}"), F.lit(0)) for d in before), F.lit(0))
    value = (F.col("_val") + F.signum("_val") * boost) * F.pow(F.lit(NEGATION), turns)
    s = tok.groupBy("_id").agg(F.sum(value).alias("_s"))
    return (df.join(s.withColumnRenamed("_id", id_col), id_col, "left")
              .withColumn(out, normalise(F.coalesce(F.col("_s"), F.lit(0.0)), alpha)).drop("_s"))


def daily_mean(df: DataFrame, date: Column | str, value: str, out: str = "avg_sentiment") -> DataFrame:
    d = F.col(date) if isinstance(date, str) else date
    return df.groupBy(d.alias("date")).agg(F.avg(F.col(value)).alias(out),
                                           F.count(F.lit(1)).alias("n_docs"))

