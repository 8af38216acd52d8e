"""Alignment of two tokenizers over a corpus.

Both tokenizers cut the same bytes, so a document is two ascending lists of token ends.
Galloping intersection: every end of the shorter list finds its rank in the longer one by an
exponential, then a binary search from the rank of an earlier end (all tokens of a part of
the texts in lockstep). Ends that both lists have cut the tokens into groups; the ranks of a
token's two ends give the range of tokens that it overlaps.

How many documents hold an id pair linked is counted over the corpus:

1. ``chunks``: some documents each, with the distinct pairs they hold and, per document,
   places in that list.
2. Pairs are summed over chunks; every A id's highest count is known from them.
3. Counts are joined back to the chunks' pairs, and every chunk sums per document.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table
from orrery.llm.lm_score import pack, pack_sorted, unpack, unpack_sorted
from orrery.llm.text_batches import Numbers, often, parts, record_batch, take_runs

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
PART_BYTES = 1 << 20
CHUNK_LINKS = 1 << 21
KNOWN_SEGMENTS = 250_000  # remembered per Python worker
ANCHOR = 32  # every so many ends of the shorter list start from the text's first


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones
    themselves, the others characters from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache
def byte_level(path: str):
    """(encode texts to id lists, bytes by id) of a byte-level tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are plain text
    symbols, table = byte_symbols(), [b""] * t.get_vocab_size(with_added_tokens=True)
    for token, i in t.get_vocab(with_added_tokens=True).items():
        table[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
    return lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)], table


@lru_cache
def piece_level(path: str):
    """(encode texts to id lists, bytes by id) of a sentence-piece model; it adds a space."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    table = [bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
             for i in range(p.get_piece_size())]
    return lambda texts: p.encode(texts, num_threads=1), table


class Tokens:
    """Ids of both tokenizers for texts, by segments that are encoded once each.

    A text is cut at single spaces between other characters. Neither tokenizer has a token
    across such a cut, so the ids of the segments are those of the text. A segment that one
    of them does not give back byte by byte sends its text to whole encoding.
    """

    def __init__(self, a_path: str, b_path: str, most: int = KNOWN_SEGMENTS):
        (self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b) = byte_level(a_path), piece_level(b_path)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.most = most
        self.known, self.whole, self.uses = Numbers(), np.zeros(0, bool), np.zeros(0, np.int64)
        # per tokenizer: ids of all segments, where each segment's begin, how many it has
        self.flat = [np.zeros(0, np.int32)] * 2
        self.starts, self.counts = [np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 2

    def _forget(self):
        """All segments but the more frequent ones."""
        chosen = often(self.uses, self.most // 2)
        self.known.keep(chosen)
        self.whole, self.uses = self.whole[chosen], np.zeros(len(chosen), np.int64)
        for k in (0, 1):
            self.flat[k] = take_runs(self.flat[k], self.starts[k][chosen], self.counts[k][chosen])
            self.counts[k] = self.counts[k][chosen]
            self.starts[k] = np.cumsum(self.counts[k]) - self.counts[k]

    def _both(self, texts: list[str]):
        """Ids by A of a space and the text, ids by B, and whether both give the bytes back."""
        spaced = [" " + t for t in texts]
        for text, x, y in zip(spaced, self.encode_a(spaced), self.encode_b(texts)):
            whole = text.encode()
            yield x, y, b"".join(map(self.bytes_a.__getitem__, x)) == whole == b"".join(map(self.bytes_b.__getitem__, y))

    def _learn(self, segments: list[str]) -> None:
        # white space at the ends of a segment: more than one between others, so no cut
        got = list(self._both(segments))
        self.whole = np.append(self.whole, [not good or not s or s[0].isspace() or s[-1].isspace() for s, (_, _, good) in zip(segments, got)])
        for k in (0, 1):
            n = np.array([len(g[k]) for g in got], np.int64)
            self.starts[k] = np.append(self.starts[k], len(self.flat[k]) + np.cumsum(n) - n)
            self.counts[k] = np.append(self.counts[k], n)
            self.flat[k] = np.append(self.flat[k], np.fromiter(chain.from_iterable(g[k] for g in got), np.int32, n.sum()))

    def encode(self, texts: list[str | None]):
        """((ids by A, numbers of them per text), the same by B); none for a text that is null,
        empty or not given back by both."""
        if len(self.known) > self.most:
            self._forget()
        split = [t.split(" ") if t else [] for t in texts]
        n = np.array([len(x) for x in split], np.int64)
        at = self.known.of(chain.from_iterable(split), n.sum())
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        self.uses = np.append(self.uses, np.zeros(len(self.known) - len(self.uses), np.int64)) + np.bincount(at, minlength=len(self.known))
        text = np.repeat(np.arange(len(texts)), n)
        odd = np.flatnonzero(np.bincount(text, self.whole[at], minlength=len(texts)))
        cut = ~np.isin(text, odd) if len(odd) else slice(None)
        at, text = at[cut], text[cut]
        out = []
        for k in (0, 1):
            counts = self.counts[k][at]
            out.append([take_runs(self.flat[k], self.starts[k][at], counts).astype(np.int64), np.bincount(text, counts, minlength=len(texts)).astype(np.int64)])
        if len(odd):
            lists = [np.split(ids, np.cumsum(n)[:-1]) for ids, n in out]
            for i, (x, y, good) in zip(odd, self._both([texts[i] for i in odd])):
                lists[0][i], lists[1][i] = (np.array(z if good else [], np.int64) for z in (x, y))
            out = [[np.concatenate(z), np.array([len(v) for v in z], np.int64)] for z in lists]
        return out


@lru_cache
def tokens(a_path: str, b_path: str) -> Tokens:
    """One per Python worker: what it has learned serves all its tasks."""
    return Tokens(a_path, b_path)


def gallop(keys: np.ndarray, ends: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each key the first place from ``start`` on whose end is not below it; the end at
    ``last`` never is."""
    low, high, step = start.copy(), start.copy(), 1
    at = np.flatnonzero(ends[high] < keys)
    while len(at):
        low[at] = high[at] + 1
        high[at] = np.minimum(high[at] + step, last[at])
        step *= 2
        at = at[ends[high[at]] < keys[at]]
    at = np.flatnonzero(low < high)
    while len(at):
        mid = (low[at] + high[at]) // 2
        below = ends[mid] < keys[at]
        low[at], high[at] = np.where(below, mid + 1, low[at]), np.where(below, high[at], mid)
        at = at[low[at] < high[at]]
    return low


def intersect(short: np.ndarray, n_short: np.ndarray, long: np.ndarray, n_long: np.ndarray):
    """Ranks of the ends ``short`` in the ends ``long`` and whether they are equal there.

    Both hold all texts one after another, ``n_short`` and ``n_long`` ends each, as positions
    in the joined texts; a text's last ends are equal."""
    first = np.repeat(np.cumsum(n_long) - n_long, n_short)
    last = np.repeat(np.cumsum(n_long) - 1, n_short)
    place = np.arange(len(short)) - np.repeat(np.cumsum(n_short) - n_short, n_short)
    rank = np.zeros(len(short), np.int64)
    anchors = np.flatnonzero(place % ANCHOR == 0)
    rank[anchors] = gallop(short[anchors], long, first[anchors], last[anchors])
    rest = np.flatnonzero(place % ANCHOR)
    rank[rest] = gallop(short[rest], long, rank[rest - place[rest] % ANCHOR], last[rest])
    return rank, long[rank] == short


class Aligned:
    """Texts aligned: ids ``a`` and ``b``, ``n_a`` and ``n_b`` per text; of all groups the
    numbers of tokens ``group_a`` and ``group_b``, ``n_groups`` per text; of all links the
    places ``link_a`` and ``link_b`` in ``a`` and ``b``, ascending, ``n_links`` per text."""

    def __init__(self, texts: list[str | None], by: Tokens):
        (self.a, self.n_a), (self.b, self.n_b) = by.encode(texts)
        ends_a, ends_b = np.cumsum(by.sizes_a[self.a]), np.cumsum(by.sizes_b[self.b])
        # per text the tokenizer with fewer tokens drives the search
        swap = self.n_b < self.n_a
        short, n_short = self._choose(swap, ends_b, self.n_b, ends_a, self.n_a)
        long, n_long = self._choose(swap, ends_a, self.n_a, ends_b, self.n_b)
        rank, equal = intersect(short, n_short, long, n_long)
        place = np.arange(len(short))
        text = np.repeat(np.arange(len(texts)), n_short)
        # groups end where ends are equal
        common = np.flatnonzero(equal)
        self.n_groups = np.bincount(text[common], minlength=len(texts))
        sizes = np.diff(place[common], prepend=-1), np.diff(rank[common], prepend=-1)
        swapped = np.repeat(swap, self.n_groups)
        self.group_a, self.group_b = np.where(swapped, sizes[1], sizes[0]), np.where(swapped, sizes[0], sizes[1])
        # a token overlaps what lies between the ranks of its two ends
        first = np.concatenate([[0], rank[:-1] + equal[:-1]])[:len(rank)]
        n = rank - first + 1
        self.n_links = np.bincount(text, n, minlength=len(texts)).astype(np.int64)
        link_short = np.repeat(place, n)
        link_long = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        # places of a text's tokens in both joined lists are the same: only roles change
        swapped = np.repeat(swap, self.n_links)
        at = np.cumsum(n_short) - n_short, np.cumsum(n_long) - n_long, np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        from_short, from_long, to_a, to_b = (np.repeat(x, self.n_links) for x in at)
        in_short, in_long = link_short - from_short, link_long - from_long
        self.link_a = to_a + np.where(swapped, in_long, in_short)
        self.link_b = to_b + np.where(swapped, in_short, in_long)

    @staticmethod
    def _choose(swap, x, n_x, y, n_y):
        """Ends of ``x`` for the texts where ``swap``, else of ``y``."""
        n = np.where(swap, n_x, n_y)
        start = np.where(swap, np.cumsum(n_x) - n_x, len(x) + np.cumsum(n_y) - n_y)
        return np.concatenate([x, y])[np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)], n

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` per text: the ids of its groups."""
        before_a, before_b = np.cumsum(self.group_a) - self.group_a, np.cumsum(self.group_b) - self.group_b
        # all ids in the order in which they are written, and what follows each
        n = len(self.a) + len(self.b)
        ids, follows = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[np.arange(len(self.a)) + np.repeat(before_b, self.group_a)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(before_a + self.group_a, self.group_b)] = self.b
        follows[before_a + before_b + self.group_a - 1] = ord("|")
        follows[before_a + before_b + self.group_a + self.group_b - 1] = ord(";")
        digits = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, 6))
        ends = np.cumsum(digits + 1)
        said, rest = np.zeros(ends[-1] if n else 0, np.uint8), ids
        said[ends - 1] = follows
        at, place = np.arange(n), ends - 2
        while len(at):
            rest, last = np.divmod(rest, 10)
            said[place] = last + ord("0")
            more = np.flatnonzero(rest)
            at, place, rest = at[more], place[more] - 1, rest[more]
        edges = np.concatenate([[0], ends])[np.cumsum(self.n_a + self.n_b)]
        return [x[:-1].tobytes() for x in np.split(said, edges[:-1])] if len(edges) else []


ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, group_a array<int>, group_b array<int>, link_a array<int>, link_b array<int>"


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the ids of both tokenizers over a space and the text, the numbers
    of tokens in each group, and for every link the places of its tokens in both lists.

    ``a_path`` is a byte-level tokenizer file, ``b_path`` a sentence-piece model that adds the
    space. Null or empty text, and a text that either does not give back byte by byte: empty
    arrays. Repeated rows and ids: rows of their own. Empty table: empty result. Other
    columns are not read.
    """
    kind = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), *[(c, kind) for c in ("a_ids", "b_ids", "group_a", "group_b", "link_a", "link_b")]])

    def lists(values, n):
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))

    def run(batches):
        for b in parts(batches, "text", PART_BYTES):
            g = Aligned(b.column("text").to_pylist(), tokens(a_path, b_path))
            link_a = g.link_a - np.repeat(np.cumsum(g.n_a) - g.n_a, g.n_links)
            link_b = g.link_b - np.repeat(np.cumsum(g.n_b) - g.n_b, g.n_links)
            yield record_batch(schema, [b.column("doc_id"), lists(g.a, g.n_a), lists(g.b, g.n_b), lists(g.group_a, g.n_groups),
                                        lists(g.group_b, g.n_groups), lists(link_a, g.n_links), lists(link_b, g.n_links)])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ALIGNED)


CHUNKS = ("chunk string, docs array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
          "pairs binary, pair_docs binary, n_places binary, places binary, times binary")


def chunks(docs: DataFrame, a_path: str, b_path: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Rows of documents with about ``chunk_links`` links: their numbers and group digests,
    the chunk's distinct pairs (A id << 32 | B id) with their numbers of documents, and of
    every document the places of its pairs in that list and how often each is linked."""
    schema = pa.schema([("chunk", pa.string()), *[(c, pa.list_(pa.int64())) for c in ("docs", "n_a", "n_b", "n_groups", "n_links")],
                        ("groups", pa.list_(pa.string())), *[(c, pa.binary()) for c in ("pairs", "pair_docs", "n_places", "places", "times")]])

    def cut(batches):
        task, n_rows, size, held = TaskContext.get().partitionId(), 0, 0, []

        def row():
            # the chunk's pairs, and of every part's pairs their places in them
            pairs, place = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
            edges = np.cumsum([len(h[1]) for h in held])
            pair_docs = np.zeros(len(pairs), np.int64)
            steps = []
            for h, of in zip(held, np.split(place, edges[:-1])):
                at, n = of[h[2]], h[3]
                np.add.at(pair_docs, of, np.bincount(h[2], minlength=len(of)))
                # places ascend within a document, so what is kept are the steps between them
                step = np.diff(at, prepend=0)
                starts = (np.cumsum(n) - n)[n > 0]
                step[starts] = at[starts]
                steps.append(step.astype(np.uint32))
            columns = [sum((h[0][i] for h in held), []) for i in range(6)]
            packed = [pairs.astype(np.uint64), pair_docs.astype(np.uint32), np.concatenate([h[3] for h in held]).astype(np.uint32), np.concatenate(steps),
                      np.concatenate([h[4] for h in held])]
            return record_batch(schema, [[f"{task}-{n_rows}"], *[[c] for c in columns], [pack_sorted(packed[0])], *[[pack(x)] for x in packed[1:]]])

        for b in parts(batches, "text", PART_BYTES):
            g = Aligned(b.column("text").to_pylist(), tokens(a_path, b_path))
            # distinct pairs of the part, and of every document in order
            at, pairs = pd.factorize((g.a[g.link_a] << 32) | g.b[g.link_b])
            order = np.argsort(pairs)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            doc = np.repeat(np.arange(b.num_rows), g.n_links)
            keys = np.sort(doc * max(1, len(pairs)) + rank[at])
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            times = np.diff(new, append=len(keys)).astype(np.uint32)
            doc, place = np.divmod(keys[new], max(1, len(pairs)))
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in g.groups()]
            numbers = [b.column("doc_id").to_pylist(), *[x.tolist() for x in (g.n_a, g.n_b, g.n_groups, g.n_links)], digests]
            held.append((numbers, pairs[order], place.astype(np.int32), np.bincount(doc, minlength=b.num_rows), times))
            size += len(at) + b.num_rows
            if size >= chunk_links:
                yield row()
                n_rows, size, held = n_rows + 1, 0, []
        if held:
            yield row()

    return docs.mapInArrow(cut, CHUNKS)


def pairs(chunked: DataFrame) -> DataFrame:
    """chunk, pair, n_docs: the distinct pairs of every chunk."""
    schema = pa.schema([("chunk", pa.string()), ("pair", pa.int64()), ("n_docs", pa.int64())])

    def expand(batches):
        for b in batches:
            for chunk, keys, n in zip(*[b.column(c).to_pylist() for c in ("chunk", "pairs", "pair_docs")]):
                keys, n = unpack_sorted(keys).astype(np.int64), unpack(n, np.uint32).astype(np.int64)
                for i in range(0, len(keys), 1 << 16):
                    k = keys[i:i + (1 << 16)]
                    yield record_batch(schema, [pa.repeat(pa.scalar(chunk), len(k)), pa.array(k), pa.array(n[i:i + len(k)])])

    return chunked.select("chunk", "pairs", "pair_docs").mapInArrow(expand, "chunk string, pair long, n_docs long")


def pair_counts(chunked: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n_docs, best: documents of the corpus that hold each pair linked, and
    whether no other pair of its A id has more. A written table."""
    counts = materialize(pairs(chunked).groupBy("pair").agg(F.sum("n_docs").alias("n_docs")), "counts")
    counts = counts.withColumn("a_id", F.shiftright("pair", 32).cast("int"))
    highest = counts.groupBy("a_id").agg(F.max("n_docs").alias("highest"))  # at most a row per A id
    return materialize(counts.join(highest, "a_id").select("pair", "a_id", F.expr("cast(pair & 4294967295 as int)").alias("b_id"), "n_docs",
                                                          (F.col("n_docs") == F.col("highest")).alias("best")), "counts")


SCORES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def link_scores(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """One row per document: numbers of tokens, groups and links of ``align``; links whose
    pair is linked in more documents of the corpus than (or as many as) any other of its A
    id; the sum of these numbers over its links; a digest of the ids of its groups.

    Odd rows as in ``align``: without tokens all numbers are 0 and the digest is empty.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunked = materialize(chunks(d, a_path, b_path, chunk_links), "chunks")
    counts = pair_counts(chunked)
    told = pairs(chunked).select("chunk", "pair").join(counts.select("pair", "n_docs", "best"), "pair")
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])

    def score(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = []
        theirs = theirs.sort_by("pair")
        n_docs, best = theirs.column("n_docs").to_numpy(), theirs.column("best").to_numpy().astype(np.int64)
        for row in mine.to_pylist():
            n, times = unpack(row["n_places"], np.uint32).astype(np.int64), unpack(row["times"], np.uint32).astype(np.int64)
            steps = unpack(row["places"], np.uint32).astype(np.int64)
            total = np.cumsum(steps)
            starts = np.cumsum(n) - n
            base = np.concatenate([[0], total])[starts]  # steps start anew with each document
            place = total - np.repeat(base, n)
            add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.append(starts, len(x))])
            out.append(pa.table([pa.array(row[c], pa.int64()) for c in ("docs", "n_a", "n_b", "n_groups", "n_links")]
                                + [pa.array(add(best[place] * times)), pa.array(add(n_docs[place] * times)), pa.array(row["groups"], pa.string())], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return chunked.drop("pairs", "pair_docs").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, SCORES)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return link_scores(read_table(spark, sf_dir, "documents"), path(BYTE_TOKENIZER), path(PIECE_TOKENIZER))
