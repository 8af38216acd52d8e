"""Removal of lines that spread over many sites (boilerplate).

Every line's hash gets a HyperLogLog sketch of the sites it occurs on; sketches merge by
aggregation. Lines whose estimate is clearly above the threshold are boilerplate, those
clearly below are not, and for those near it the distinct sites are counted exactly.
Boilerplate lines are then removed from the documents that they frame. In a document made
mostly of spread lines, those that frame several different texts elsewhere are boilerplate
and cut; the others come from copies of a whole page and are left, for near-duplicate
removal to keep one of its kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import SPACES, free_name, materialize, read_table

MIN_SITES = 6
MARGIN = 0.25
LG_K = 10
MAX_PERCENT = 50
MIN_TEXTS = 6


def line_key(line: Column) -> Column:
    """128-bit key of a line, white space at its ends ignored."""
    return F.unhex(F.md5(F.btrim(line, F.lit(SPACES))))


def text_lines(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line with a word: ``keep``, at (0-based), key, size."""
    lines = F.posexplode(F.split(F.col(text), "\n"))
    d = docs.filter(F.col(text).isNotNull()).select(*keep, lines.alias("at", "line"))
    return d.filter(F.btrim("line", F.lit(SPACES)) != "").select(*keep, "at", line_key(F.col("line")).alias("key"), F.length("line").alias("size"))


def spread_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
                 margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """(key, sites) of the lines that occur on at least ``min_sites`` distinct sites.

    ``sites`` is exact for lines whose estimate lies within ``margin`` of the threshold
    and the sketch's estimate for those above. Null sites count as no site. The margin is
    some eight standard errors of a sketch with 2**lg_k registers.
    """
    d = docs.select(F.col(text).alias("text"), F.col(site).alias("site")).filter("site is not null")
    sketch = text_lines(d, "text", "site").groupBy("key").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
    # few lines reach the lower bound, so the rest of the work is on a small table
    table = materialize(sketch.select("key", F.hll_sketch_estimate("sketch").alias("estimate"))
                              .filter(F.col("estimate") >= min_sites * (1 - margin)), "estimates")
    near = table.filter(F.col("estimate") <= min_sites * (1 + margin)).select("key")
    exact = (text_lines(d, "text", "site").join(near, "key").groupBy("key", "site").agg(F.lit(1).alias("one"))
             .groupBy("key").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites))
    far = table.filter(F.col("estimate") > min_sites * (1 + margin)).select("key", F.col("estimate").alias("sites"))
    return far.unionByName(exact)


def remove_spread_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
                        max_percent: int = MAX_PERCENT, margin: float = MARGIN, lg_k: int = LG_K, min_texts: int | None = MIN_TEXTS) -> DataFrame:
    """``docs`` with spread lines cut out of ``text``, and the columns n_spread (lines found)
    and n_removed (lines cut; both with underscores appended if the name is taken).

    A document is framed by spread lines that make up at most ``max_percent`` percent of its
    code points (line feeds aside): all of them are cut. Of the others the lines are cut that
    frame at least ``min_texts`` distinct texts (null: none); a copied page keeps its lines,
    as they frame nothing. All rows and columns are kept; the other lines stay as they are,
    joined by line feeds. Null text stays null, with 0 lines; rows with a null site are
    cleaned too, but spread no line. Empty table: empty result.
    """
    n_spread, n_removed = free_name(docs, "n_spread"), free_name(docs, "n_removed")
    spread = materialize(spread_lines(docs, text, site, min_sites, margin, lg_k), "spread").select("key")
    keyed = docs.withColumn("__text", F.unhex(F.md5(F.col(text))))
    # the places of spread lines depend on the text only: a row per distinct text and line
    texts = docs.select(F.col(text).alias("__t"), F.unhex(F.md5(F.col(text))).alias("__hit"),
                        F.length(F.translate(F.col(text), "\n", "")).alias("__all"))
    hits = (text_lines(texts, "__t", "__hit", "__all").join(spread, "key")
            .groupBy("__hit", "at").agg(F.first("size").alias("size"), F.first("key").alias("key"), F.first("__all").alias("__all"))
            .groupBy("__hit").agg(F.collect_list(F.struct("at", "key")).alias("lines"), F.sum("size").alias("chars"), F.first("__all").alias("__all")))
    framed = F.col("chars") * 100 <= F.col("__all") * max_percent
    hits = materialize(hits.select("__hit", "lines", framed.alias("framed")), "hits")
    at = F.col("lines.at")
    cuts = hits.filter("framed").select("__hit", at.alias("__at"), at.alias("__cut"))
    rest = hits.filter("not framed")
    if min_texts is None:
        cuts = cuts.unionByName(rest.select("__hit", at.alias("__at"), F.array().cast("array<int>").alias("__cut")))
    else:
        frames = (hits.filter("framed").select(F.explode(F.array_distinct("lines.key")).alias("key"))
                  .groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= min_texts).select("key"))
        one = rest.select("__hit", F.explode("lines").alias("line")).select("__hit", "line.at", "line.key")
        one = one.join(frames.withColumn("frames", F.lit(True)), "key", "left")
        # collect_list leaves out nulls
        cuts = cuts.unionByName(one.groupBy("__hit").agg(F.collect_list("at").alias("__at"), F.collect_list(F.when(F.col("frames"), F.col("at"))).alias("__cut")))
    cuts = materialize(cuts, "cuts")  # a table, so that the join below may split a text with many copies
    j = keyed.join(cuts, F.col("__text") == F.col("__hit"), "left")
    left = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("__cut", i))
    count = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c)).cast("long")
    return (j.withColumns({n_spread: count("__at"), n_removed: count("__cut")})
             .withColumn(text, F.when(F.col(n_removed) > 0, F.array_join(left, "\n")).otherwise(F.col(text)))
             .select(*docs.columns, n_spread, n_removed))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_spread_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_spread", "n_removed")


SQL = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS key FROM l),
s AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 6),
m AS (SELECT k.*, s.key IS NOT NULL AS hit FROM k LEFT JOIN s ON k.key = s.key),
g AS (SELECT doc_id, coalesce(sum(length(line)) FILTER (WHERE hit), 0) * 2 <= sum(length(line)) AS framed FROM m GROUP BY doc_id),
f AS (SELECT m.key FROM m JOIN g USING (doc_id) JOIN documents d USING (doc_id) WHERE hit AND framed GROUP BY m.key HAVING count(DISTINCT d.text) >= 6),
c AS (SELECT m.*, hit AND (framed OR f.key IS NOT NULL) AS cut FROM m JOIN g USING (doc_id) LEFT JOIN f ON f.key = m.key),
r AS (SELECT doc_id, count(*) FILTER (WHERE hit) AS n_spread, count(*) FILTER (WHERE cut) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '') AS text FROM c GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN r.n_removed > 0 THEN r.text ELSE d.text END AS text, coalesce(r.n_spread, 0) AS n_spread, coalesce(r.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN r USING (doc_id)
"""
