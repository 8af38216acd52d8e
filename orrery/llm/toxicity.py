"""Toxicity severity by cumulative-link ordinal regression on hashed text features.

Features of a document are its words and their prefixes, hashed to ``2**BITS`` columns,
counted and divided by the root of the number of words. One weight vector serves all
grades; ordered thresholds cut the score:

    P(grade > k) = sigmoid(w.x - b_k),   b_0 <= b_1 <= ...

and the expected severity is the sum of these probabilities. The grades of the labelled
rows: 0 where ``toxic`` is 0; toxic rows have grades from 1 up by the share of their features
that occur in toxic rows far more often than in others (grades of equal size).

The model is fitted on a bounded sample of the labelled rows (parameters below); scoring
reads every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table

BITS = 18
PREFIXES = (4, 5, 6, 7)
# the sample that the model is fitted on: rows of each class, words of a row at most
SAMPLE_ROWS = 2000
SAMPLE_WORDS = 2000
GRADES = 3
MIN_ROWS = 3  # sample rows that a feature must occur in
L2 = 3e-3
STEPS = 200
REJECT_AT = 0.5

_WORD = re.compile(r"[^\W\d_]+")


class Features:
    """Feature columns of words, remembered up to ``most`` words per task."""

    def __init__(self, most: int = 1 << 20):
        self.known, self.most = {}, most

    def of_word(self, w: str) -> tuple[int, ...]:
        got = self.known.get(w)
        if got is None:
            if len(self.known) >= self.most:
                self.known.clear()
            parts = [w + "$"] + [w[:n] for n in PREFIXES if len(w) >= n]
            got = self.known[w] = tuple(zlib.crc32(p.encode()) & ((1 << BITS) - 1) for p in parts)
        return got


def text_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Model:
    """Weights per hashed feature and the ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return (1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))).sum(1)


@dataclass
class Rows:
    """Sparse rows: columns and values of row i are at starts[i]:starts[i + 1]."""

    starts: np.ndarray
    cols: np.ndarray
    vals: np.ndarray


def matrix(texts: Iterable[str | None]) -> Rows:
    """Features of texts, read one at a time."""
    f, starts, cols, vals = Features(1 << 16), [0], [], []
    for t in texts:
        words = text_words(t)
        c, n = np.unique(np.fromiter((x for w in words for x in f.of_word(w)), np.int32), return_counts=True)
        cols.append(c)
        vals.append((n / np.sqrt(max(1, len(words)))).astype(np.float32))
        starts.append(starts[-1] + len(c))
    return Rows(np.array(starts), np.concatenate(cols or [np.zeros(0, np.int32)]), np.concatenate(vals or [np.zeros(0, np.float32)]))


def _rows_with(rows: Rows, toxic: np.ndarray) -> list[np.ndarray]:
    """Per class (0, 1) and feature: rows that have it."""
    y = np.repeat(toxic, np.diff(rows.starts))
    return [np.bincount(rows.cols[y == k], minlength=1 << BITS) for k in (0, 1)]


def grades(rows: Rows, toxic: np.ndarray, levels: int = GRADES) -> np.ndarray:
    """0 for rows that aren't toxic; for the others 1 .. levels - 1 by their share of
    features that are typical of toxic rows."""
    n = [max(1, int((toxic == y).sum())) for y in (0, 1)]
    clean, bad = _rows_with(rows, toxic)
    typical = (bad >= MIN_ROWS) & (bad / n[1] > 8 * (clean + 0.5) / n[0])
    of = np.repeat(np.arange(len(toxic)), np.diff(rows.starts))
    share = np.bincount(of, rows.vals * typical[rows.cols], len(toxic)) / np.maximum(1e-9, np.bincount(of, rows.vals, len(toxic)))
    out = np.zeros(len(toxic), np.int64)
    rank = np.argsort(np.argsort(share[toxic == 1], kind="stable"), kind="stable")
    out[toxic == 1] = 1 + rank * (levels - 1) // max(1, len(rank))
    return out


def fit(rows: Rows, y: np.ndarray, levels: int = GRADES, l2: float = L2, steps: int = STEPS) -> Model:
    """Penalised maximum likelihood of the cumulative-link model by Adam; the thresholds
    stay ordered as the first plus positive gaps. Rows of grade 0 and of the grades above
    weigh the same in sum. Without rows of two grades the severity is 0."""
    cols, row = rows.cols, np.repeat(np.arange(len(y)), np.diff(rows.starts))
    often = np.bincount(cols, minlength=1 << BITS)[cols] >= MIN_ROWS
    row, cols, vals = row[often], cols[often], rows.vals[often]
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    if len(np.unique(y)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), np.full(levels - 1, 40.0))
    used, cols = np.unique(cols, return_inverse=True)
    # features start scaled by the log ratio of the classes' shares of rows that have them
    has = [np.bincount(cols[(y > 0)[row] == k], minlength=len(used)) + 0.5 for k in (False, True)]
    ratio = np.log(has[1] / ((y > 0).sum() + 1)) - np.log(has[0] / ((y == 0).sum() + 1))
    vals = vals * ratio[cols]
    theta = np.zeros(len(used) + levels - 1)  # weights, b_0, log gaps
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, b0, gaps = theta[:len(used)], theta[len(used)], np.exp(theta[len(used) + 1:])
        b = b0 + np.concatenate([[0], np.cumsum(gaps)])
        s = np.bincount(row, vals * w[cols], len(y))
        p = 1 / (1 + np.exp(-np.clip(s[:, None] - b, -40, 40)))
        # P(y) = p[y-1] - p[y], with p[-1] = 1 and p[levels-1] = 0
        upper = np.concatenate([np.ones((len(y), 1)), p], 1)[np.arange(len(y)), y]
        lower = np.concatenate([p, np.zeros((len(y), 1))], 1)[np.arange(len(y)), y]
        like = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / like, lower * (1 - lower) / like
        ds = -(du - dl) * each  # gradient of the weighted loss by the score
        db = np.zeros(levels - 1)
        np.add.at(db, y[y > 0] - 1, (du * each)[y > 0])
        np.add.at(db, y[y < levels - 1], -(dl * each)[y < levels - 1])
        tail = np.cumsum(db[::-1])[::-1]
        g = np.concatenate([np.bincount(cols, vals * ds[row], len(used)) + l2 * w, [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    out = np.zeros(1 << BITS, np.float32)
    out[used] = theta[:len(used)] * ratio
    return Model(out, theta[len(used)] + np.concatenate([[0], np.cumsum(np.exp(theta[len(used) + 1:]))]))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                  rows: int = SAMPLE_ROWS, words: int = SAMPLE_WORDS) -> tuple[Rows, np.ndarray]:
    """A sample of the labelled rows: of each class the ``rows`` ids that come first by MD5,
    without texts of more than ``words`` words. Null ids, labels and texts are left out."""
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(
        (F.max(label) > 0).cast("int").alias("toxic"))
    order = F.md5(F.col("__id").cast("string"))
    part = [known.filter(F.col("toxic") == y).orderBy(order, "__id").limit(rows) for y in (0, 1)]
    picked = F.broadcast(part[0].unionByName(part[1]))  # 2 * rows ids at most
    got = (docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
               .join(picked, "__id").filter(F.size(F.split("__text", r"\s+")) <= words)
               .groupBy("__id", "toxic").agg(F.min("__text").alias("__text")).orderBy("__id"))
    toxic = []

    def texts():  # a partition at a time; only features stay on the driver
        for r in materialize(got, "sample").toLocalIterator():
            toxic.append(r["toxic"])
            yield r["__text"]

    m = matrix(texts())
    return m, np.array(toxic, np.int64)


def train(docs: DataFrame, labels: DataFrame, **names) -> Model:
    """Fit the model on a bounded sample of the labelled rows."""
    rows, toxic = training_rows(docs, labels, **names)
    return fit(rows, grades(rows, toxic))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "severity") -> DataFrame:
    """Append the expected severity (double, 0 .. grades - 1) of every whole text.

    Null, empty or wordless text: 0. All rows and columns are kept; a column called
    ``out`` is replaced.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    d = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats
    schema = StructType([*d.schema.fields, StructField(out, DoubleType())])
    at = [c.lower() for c in d.columns].index(text.lower())

    def scored(batches):
        model, f, weight = shared.value, Features(), {}
        w = model.weights
        for b in batches:
            got = np.zeros(b.num_rows)
            empty = np.zeros(b.num_rows, bool)
            for i, t in enumerate(b.column(at)):
                words = text_words(t.as_py())
                empty[i] = not words
                if len(weight) > f.most:
                    weight.clear()
                for x in set(words).difference(weight):
                    weight[x] = float(w[list(f.of_word(x))].sum())
                got[i] = sum(map(weight.__getitem__, words)) / max(1, len(words)) ** 0.5
            severity = np.where(empty, 0.0, model.expected(got))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(severity)], names=[*b.schema.names, out])

    return d.mapInArrow(scored, schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", "severity", (F.col("severity") >= REJECT_AT).alias("toxic"))
