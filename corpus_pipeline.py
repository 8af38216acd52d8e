"""The corpus pipeline: documents → training mix.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents, extra columns included.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from orrery.llm.common import free_name, materialize, read_table


def drop_toxic(spark, docs, sf_dir):
    """Without the documents whose expected severity reaches ``toxicity.REJECT_AT``.

    The model is fitted on this stage's documents and the labels table. Null or empty
    text has severity 0 and stays; without labels of both kinds all documents stay.
    """
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    severity = free_name(docs, "severity")
    return toxicity.score(docs, model, out=severity).filter(F.col(severity) < toxicity.REJECT_AT).drop(severity)


def remove_boilerplate(spark, docs, sf_dir):
    """Every document, its lines that spread over many sources cut (see ``line_dedup``)."""
    return line_dedup.remove_spread_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the
    one with the smallest id. Documents without words stay. Of rows that repeat an id and its
    text one stays; a group of none but null ids keeps one row per text."""
    kept = near_dedup.near_duplicates(docs, n=5, percent=80).filter("kept").select(F.col("row_key").alias("__kept")).distinct()
    keyed = docs.withColumn("__row", near_dedup.row_key(F.col("doc_id"), F.col("text")))
    out = keyed.join(kept, F.col("__row") == F.col("__kept"), "left_semi")
    return out.dropDuplicates(["__row"]).select(*docs.columns)


def drop_leaks(spark, docs, sf_dir):
    """Without the documents that a benchmark item leaks into."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Targets, taken words and training position of every document that is left."""
    return mixing.mix(docs).drop("positions")


STAGES = [
    ("drop_toxic", drop_toxic),
    ("remove_boilerplate", remove_boilerplate),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_leaks", drop_leaks),
    ("mix_sources", mix_sources),
]

# the toxicity model is fitted, so SQL can't express the rows; tests/llm holds each stage
# against a brute-force version
ORACLE_SQL = None


def run(spark, sf_dir):
    """The mix of the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
