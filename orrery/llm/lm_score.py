"""Stupid-backoff language-model scores of documents under the whole corpus.

The n-gram counts are a table partitioned by hash that is joined to the documents' n-grams,
both in packed form, because single rows would take several times the corpus:

1. ``chunks``: some documents each, as sorted distinct word hashes and places in them.
2. ``posts``: per chunk, order and hash partition the sorted distinct n-grams with their
   counts in the chunk. A frequent n-gram is one entry per chunk, so no partition is hot.
3. ``replies``: each hash partition adds up the counts of its n-grams over all chunks and
   joins them back to its posts.
4. Every chunk meets its replies, scores each word and sums per document.

A word after its context scores count(n-gram) / count(context) for the longest n-gram that
the corpus has at least ``min_count`` times; each step down to a shorter one costs a factor
``alpha``, and a single word scores count / all words. Logarithms are rounded to millionths
per word, so that sums don't depend on their order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table
from orrery.llm.shingles import M3, Hasher, mix

ORDER = 2
MIN_COUNT = 2
ALPHA = 0.4
CHUNK_WORDS = 1 << 19
PARTITION_WORDS = 1 << 21  # words of the corpus per hash partition
KEY_BITS = 56  # of an n-gram's hash
SCORES = "doc_id long, n_words long, n_backoff long, log_score long"


def pack(a: np.ndarray) -> bytes:
    """The bytes of integers, place by place: equal high bytes compress to nothing."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unpack(b: bytes, kind) -> np.ndarray:
    k = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(k, len(b) // k).T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def chunks(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Rows of about ``chunk_words`` words: chunk, docs, sizes, vocabulary, ids, n_words."""
    names = ["chunk", "docs", "sizes", "vocabulary", "ids", "n_words"]
    kinds = [pa.string(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]

    def cut(batches):
        hasher, task, n = Hasher(), TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            vocabulary, at = np.unique(np.concatenate(texts), return_inverse=True)
            got = [f"{task}-{n}", ids, pack(np.array([len(t) for t in texts], np.uint32)), pack_sorted(vocabulary),
                   pack(at.astype(np.uint32)), len(at)]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(got, kinds)], names=names)

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                words = hasher.words(t.as_py())
                ids.append(i)
                texts.append(words)
                size += len(words)
                if size >= chunk_words or len(ids) >= chunk_words:
                    yield row()
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield row()

    return docs.mapInArrow(cut, "chunk string, docs array<long>, sizes binary, vocabulary binary, ids binary, n_words long")


def grams(words: np.ndarray, starts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order 1 .. ``order``: hash of the n-gram that ends at each word, and whether its
    document has it (``starts``: place of each word in its document)."""
    out, h = [], np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(order):
            # the word k places before joins from the left
            before = np.concatenate([np.zeros(min(k, len(words)), np.uint64), words[:max(0, len(words) - k)]])
            h = mix(h * M3 + mix(before + np.uint64(k + 1)))
            out.append((h >> np.uint64(64 - KEY_BITS), starts >= k))
    return out


def _read(row: dict, order: int):
    """Sizes of a chunk's documents, and per order the n-grams: sorted distinct, place of
    every word's in them (-1: none), counts."""
    sizes = unpack(row["sizes"], np.uint32).astype(np.int64)
    words = unpack_sorted(row["vocabulary"])[unpack(row["ids"], np.uint32)]
    starts = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    got = []
    for h, has in grams(words, starts, order):
        distinct, at, n = np.unique(h[has], return_inverse=True, return_counts=True)
        place = np.full(len(words), -1)
        place[has] = at
        got.append((distinct, place, n))
    return sizes, got


def posts(chunked: DataFrame, order: int, parts: int) -> DataFrame:
    """part, chunk, k, keys, counts: a chunk's distinct n-grams of order k by hash range."""
    schema = "part int, chunk string, k int, keys binary, counts binary"
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
    edges = [(p << KEY_BITS) // parts for p in range(1, parts)]

    def post(batches):
        for b in batches:
            for row in b.to_pylist():
                out = []
                for k, (keys, _, n) in enumerate(_read(row, order)[1]):
                    cut = [0, *np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)]
                    out += [(p, row["chunk"], k, pack_sorted(keys[i:j]), pack(n[i:j].astype(np.uint32)))
                            for p, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)],
                                                 names=["part", "chunk", "k", "keys", "counts"])

    return chunked.mapInArrow(post, schema)


def replies(posted: DataFrame) -> DataFrame:
    """part, chunk, k, counts: for every post the counts of its n-grams in the corpus."""

    def reply(table: pa.Table) -> pa.Table:
        out = [None] * table.num_rows
        order = table.column("k").to_numpy()
        for k in np.unique(order):
            at = np.flatnonzero(order == k)
            keys = [unpack_sorted(table.column("keys")[i].as_py()) for i in at]
            own = [unpack(table.column("counts")[i].as_py(), np.uint32) for i in at]
            _, place = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(place, np.concatenate(own)).astype(np.uint64)[place]
            for i, c in zip(at, np.split(total, np.cumsum([len(x) for x in keys])[:-1])):
                out[i] = pack(c)
        return table.select(["part", "chunk", "k"]).append_column("counts", pa.array(out, pa.binary()))

    return posted.groupBy("part").applyInArrow(reply, "part int, chunk string, k int, counts binary")


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, min_count: int = MIN_COUNT,
           alpha: float = ALPHA, chunk_words: int = CHUNK_WORDS, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_backoff (words not scored by a full-order
    n-gram), log_score (sum of millionths of the natural logarithm).

    Words split at space and code points 9-13, A-Z lower-cased. The first words of a
    document have shorter contexts. Null, empty or wordless text: 0 words, 0 score.
    Repeated rows and ids: rows of their own, each counted in the corpus. Empty table:
    empty result. Other columns are not read.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunked = materialize(chunks(d, chunk_words), "chunks")
    n = chunked.agg(F.sum("n_words")).first()[0] or 0
    got = replies(posts(chunked, order, max(1, -(-n // partition_words))))
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_backoff", "log_score")])

    def score(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = []
        answers = sorted(theirs.to_pylist(), key=lambda r: (r["k"], r["part"]))
        for row in mine.to_pylist():
            sizes, read = _read(row, order)
            counts = []
            for k, (_, place, _) in enumerate(read):
                c = [unpack(r["counts"], np.uint64) for r in answers if r["k"] == k]
                counts.append(np.append(np.concatenate(c), 0).astype(np.float64)[place] if c else np.zeros(len(place)))
            # from single words up: the longest n-gram that is frequent enough wins
            s = np.log(counts[0] / max(1, n))
            full = np.zeros(len(s), bool)
            for k in range(1, order):
                context = np.concatenate([[1.0], counts[k - 1][:-1]]) if len(s) else s
                full = counts[k] >= min_count
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = np.where(full, np.log(counts[k] / context), s + np.where(read[k][1] >= 0, np.log(alpha), 0.0))
            micro = np.rint(s * 1e6).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            total = lambda a: np.concatenate([[0], np.cumsum(a)])[ends[1:]] - np.concatenate([[0], np.cumsum(a)])[ends[:-1]]
            out.append(pa.table([pa.array(row["docs"], pa.int64()), pa.array(sizes), pa.array(total((~full).astype(np.int64))), pa.array(total(micro))],
                                schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return chunked.groupBy("chunk").cogroup(got.groupBy("chunk")).applyInArrow(score, SCORES)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS b, unnest(list_concat([NULL], w[1:len(w) - 1])) AS a FROM w),
n AS (SELECT count(*)::DOUBLE AS n FROM t),
u AS (SELECT b AS u, count(*)::DOUBLE AS c FROM t GROUP BY b),
p AS (SELECT a, b, count(*)::DOUBLE AS c FROM t WHERE a IS NOT NULL GROUP BY ALL),
s AS (SELECT t.doc_id, coalesce(p.c >= 2, false) AS full_order,
        CASE WHEN p.c >= 2 THEN ln(p.c / x.c) WHEN t.a IS NULL THEN ln(y.c / n.n) ELSE ln(y.c / n.n) + ln(0.4::DOUBLE) END AS s
      FROM t JOIN u y ON y.u = t.b LEFT JOIN u x ON x.u = t.a LEFT JOIN p ON p.a = t.a AND p.b = t.b CROSS JOIN n),
g AS (SELECT doc_id, CAST(count(*) FILTER (WHERE NOT full_order) AS BIGINT) AS n_backoff,
        CAST(sum(CAST(round_even(s * 1e6::DOUBLE, 0) AS BIGINT)) AS BIGINT) AS log_score FROM s GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_backoff, 0) AS n_backoff, coalesce(log_score, 0) AS log_score
FROM w LEFT JOIN g USING (doc_id)
"""
