"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets integer measures. Per (language, source) and measure a sketch
counts the values by log-linear bucket (32 buckets per power of two: a relative error
of at most 1/32). Sketches merge by adding counts: sources into languages, languages
into the corpus. A group's fences are its quartiles moved out by ``fence`` spreads; a
group with fewer than ``min_docs`` documents takes its language's fences, a language
with fewer the corpus's. The fences are joined back and documents outside are rejected.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm.common import SPACES, materialize, read_table, words
from orrery.operators.scalar_join import attach_scalar

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCS = 200
FENCE = 3
# measure -> (least spread, fenced below, fenced above); all in ten-thousandths but
# word_length, which is in hundredths of a code point
MEASURES = {
    "symbol_rate": (100, False, True),
    "dup_line_rate": (500, False, True),
    "repeat_rate": (500, False, True),
    "word_length": (50, True, True),
}


def _per(a: str, b: str, unit: int) -> Column:
    return F.expr(f"CASE WHEN {b} > 0 THEN ({unit} * {a}) div {b} ELSE 0 END")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Null or empty text: all 0. A line counts if it has a word. Words inside 3-word
    windows that occur at least twice in the text are repeat words, first occurrence
    included; windows are compared by their 64-bit hash within the text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumns({
        "__w": words(F.col(text)),
        "__l": F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != ""),
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    windows = F.transform(F.slice("__w", F.lit(1), F.greatest(F.lit(0), F.size("__w") - 2)), lambda x, i: F.struct(
        F.xxhash64(x, F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("p")))
    d = d.withColumns({
        "n_words": F.size("__w").cast("long"),
        "n_lines": F.size("__l").cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "__s": F.sort_array(windows),
    }).drop("__w", "__l")
    # equal windows are neighbours now
    twice = F.filter("__s", lambda x, i: F.get("__s", i + 1)["h"].eqNullSafe(x["h"]) | F.get("__s", i - 1)["h"].eqNullSafe(x["h"]))
    d = d.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x["p"]))).drop("__s")
    # a window adds its 3 words, less those that the next one has too
    own = F.transform("__p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__p", i + 1) - p, F.lit(3))))
    return d.withColumn("n_repeat_words", F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)).drop("__p")


def bucket(value: Column) -> Column:
    """Log-linear bucket of a value of 0 or more: exact below 64, then 32 a power of two."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - 6)
    return shift * 32 + F.floor(value / F.pow(F.lit(2.0), shift))


def bucket_low(b: Column) -> Column:
    """The least value of a bucket."""
    shift = F.greatest(F.lit(0), F.floor(b / 32) - 1)
    return ((b - shift * 32) * F.pow(F.lit(2.0), shift)).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the quantile sketches as a count table, with
    documents counted per group, measure and bucket."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES])
    return (measured.select("lang", "source", F.explode(pairs).alias("x"))
                    .groupBy("lang", "source", "x.measure", "x.bucket").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Merge a sketch table down to the groups ``by``; their size, q1 and q3 by measure."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "measure")  # a group has some hundred buckets at most
    upto = F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    merged = merged.withColumns({"upto": upto, "docs": F.sum("n").over(w)})
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * q, F.col("bucket")))
    return merged.groupBy(*by, "measure").agg(F.first("docs").alias("docs"), bucket_low(at(1)).alias("q1"), bucket_low(at(3)).alias("q3"))


def fences(sketch: DataFrame, min_docs: int = MIN_DOCS, fence: int = FENCE) -> DataFrame:
    """One row per (lang, source): ``<measure>_low`` and ``<measure>_high`` (null: none)."""
    spread = F.create_map(*[F.lit(x) for m, (s, _, _) in MEASURES.items() for x in (m, s)])

    def wide(q: DataFrame, by: list[str]) -> DataFrame:
        reach = F.greatest(F.col("q3") - F.col("q1"), spread[F.col("measure")]) * fence
        q = q.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
        return q.groupBy(*by).agg(F.max("docs").alias("docs"), *[
            F.max(F.when(F.col("measure") == m, F.struct("low", "high"))).alias(m) for m in MEASURES])

    own = wide(quartiles(sketch, ["lang", "source"]), ["lang", "source"])
    lang = wide(quartiles(sketch, ["lang"]), ["lang"]).select(F.col("lang").alias("l_lang"), F.col("docs").alias("l_docs"),
                                                              *[F.col(m).alias(f"l_{m}") for m in MEASURES])
    every = wide(quartiles(sketch, []), []).select(*[F.col(f"{m}.{e}").alias(f"a_{m}_{e}") for m in MEASURES for e in ("low", "high")])
    f = attach_scalar(own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang"))), every)
    chosen = {m: F.when(F.col("docs") >= min_docs, F.col(m)).when(F.col("l_docs") >= min_docs, F.col(f"l_{m}"))
              .otherwise(F.struct(F.col(f"a_{m}_low").alias("low"), F.col(f"a_{m}_high").alias("high"))) for m in MEASURES}
    return f.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"),
                    *[c["low"].alias(f"{m}_low") for m, c in chosen.items() if MEASURES[m][1]],
                    *[c["high"].alias(f"{m}_high") for m, c in chosen.items() if MEASURES[m][2]])


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          min_docs: int = MIN_DOCS, fence: int = FENCE) -> DataFrame:
    """One row per document: doc_id, its measures, base_failed, outside (the measures
    outside their fences) and kept.

    Null lang or source: a group like any other. Null text: no words, so base_failed.
    Repeated rows and ids: a row each, each counted. Empty table: empty result. Other
    columns are not read.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    m = measure(d).drop("text").withColumns({
        "symbol_rate": _per("n_symbols", "word_chars", 10_000),
        "dup_line_rate": _per("n_dup_lines", "n_lines", 10_000),
        "repeat_rate": _per("n_repeat_words", "n_words", 10_000),
        "word_length": _per("word_chars", "n_words", 100),
    })
    m = materialize(m, "measured")
    # fences come from what passes the base rules
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    m = m.withColumn("base_failed", failed)
    f = fences(sketches(m.filter(~F.col("base_failed"))), min_docs, fence)
    j = m.join(f, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    outside = [F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, (_, below, above) in MEASURES.items()
               for c in ([F.col(name) < F.col(f"{name}_low")] * below + [F.col(name) > F.col(f"{name}_high")] * above)]
    j = j.withColumn("outside", F.array_distinct(F.array_compact(F.array(*outside))))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "outside",
                    (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).drop("outside")

SQL = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS p, w FROM w WHERE len(w) > 2),
h AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, w[p], w[p + 1], w[p + 2]) AS k FROM g),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS p FROM h WHERE k > 1) GROUP BY rid),
b AS (SELECT t.doc_id, t.lang, t.source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(n_symbols AS BIGINT) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM t JOIN w USING (rid) LEFT JOIN r USING (rid)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN word_chars > 0 THEN 10000 * n_symbols // word_chars ELSE 0 END AS symbol_rate,
        CASE WHEN n_lines > 0 THEN 10000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_rate,
        CASE WHEN n_words > 0 THEN 10000 * n_repeat_words // n_words ELSE 0 END AS repeat_rate,
        CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length FROM b),
u AS (UNPIVOT (SELECT lang, source, symbol_rate, dup_line_rate, repeat_rate, word_length FROM m WHERE NOT base_failed)
      ON symbol_rate, dup_line_rate, repeat_rate, word_length INTO NAME measure VALUE v),
-- the least value of a bucket: what is left of v with 6 leading bits
v AS (SELECT lang, source, measure, (v >> greatest(0, length(bin(v)) - 6)) << greatest(0, length(bin(v)) - 6) AS v FROM u),
q AS (
  SELECT 1 AS level, lang, source, measure, count(*) AS docs, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM v GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, measure, count(*), quantile_disc(v, 0.25), quantile_disc(v, 0.75) FROM v GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, measure, count(*), quantile_disc(v, 0.25), quantile_disc(v, 0.75) FROM v GROUP BY ALL),
f AS (SELECT *, q1 - 3 * reach AS low, q3 + 3 * reach AS high FROM (SELECT *, greatest(q3 - q1,
        CASE measure WHEN 'symbol_rate' THEN 100 WHEN 'word_length' THEN 50 ELSE 500 END) AS reach FROM q)),
c AS (SELECT a.lang, a.source, a.measure, CASE WHEN a.docs >= 200 THEN a.low WHEN l.docs >= 200 THEN l.low ELSE e.low END AS low,
        CASE WHEN a.docs >= 200 THEN a.high WHEN l.docs >= 200 THEN l.high ELSE e.high END AS high
      FROM (SELECT * FROM f WHERE level = 1) a JOIN (SELECT * FROM f WHERE level = 2) l ON l.lang IS NOT DISTINCT FROM a.lang AND l.measure = a.measure
      JOIN (SELECT * FROM f WHERE level = 3) e ON e.measure = a.measure),
k AS (SELECT lang, source, max(high) FILTER (WHERE measure = 'symbol_rate') AS s, max(high) FILTER (WHERE measure = 'dup_line_rate') AS d,
        max(high) FILTER (WHERE measure = 'repeat_rate') AS r, max(high) FILTER (WHERE measure = 'word_length') AS hi,
        max(low) FILTER (WHERE measure = 'word_length') AS lo FROM c GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(symbol_rate > s OR dup_line_rate > d OR repeat_rate > r OR word_length > hi OR word_length < lo, false) AS kept
FROM m LEFT JOIN k ON m.lang IS NOT DISTINCT FROM k.lang AND m.source IS NOT DISTINCT FROM k.source
"""
