"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A passage of a document leaks an item of m words if some stretch of the document's words is
at most ``max_edits(m)`` word insertions, deletions or substitutions away from it.

Windows of the item's size at every word of every document are compared with the items of
that size. The CGK random walk reads a word, writes it, and moves on or stays by a random
bit of (step, word); texts at a small edit distance then agree in most written words, so
their Hamming distance is small. A repeat takes a walk of its own and ``SAMPLED`` of its
steps; windows and items with equal sampled words are candidates. The number of repeats is
chosen for each item size: of several edited copies at the largest distance the one that is
hit least must be found with the target recall. Candidates are confirmed by exact edit
distance. Where a size would need more than MOST_REPEATS, the windows left by the bound
below are compared by edit distance with all its items instead.

Before the walks a bound drops windows that can't match: an edit takes at most two word pairs
of an item from the window of its size, so a window within e edits holds all but 2 e of the
item's distinct pairs of neighbouring words. Counted are places whose pair occurs in an item
of that size and differs from the pair before, so that runs of a repeated word count little.

Items of fewer than MIN_WORDS words are searched for verbatim, in a tree of their first,
second, ... words that all places of the documents walk down together.

The items are taken in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import read_table
from orrery.llm.shingles import M3, mix

MIN_WORDS = 8  # items from this size on may differ by edits
LEAST_WORDS = 1  # shortest items that are reported, verbatim
DROP_WORDS = 4  # shortest items that take a document out: shorter ones stand in texts that know nothing of them
EDIT_SHARE = 0.2
SAMPLED = 3
RECALL = 0.999
MOST_REPEATS = 1000
BLOCK_WORDS = 200_000  # words of the items of a block
PAIR_BITS = 22  # size of the table of word pairs
WINDOWS = 4096  # windows that walk together, fewer if
WALK_BYTES = 64 << 20  # their sampled steps would take more than that
CHUNK_BYTES = 4 << 20  # text that a task works on at once
CALIBRATE_COPIES = 16  # of items of each size
CALIBRATE_TRIALS = 256  # walks that each copy is tried with
RESULT = "doc_id long, item_id long, edits long"

_TO_SPACE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def item_words(text: str | None) -> list[bytes]:
    """Words without ASCII punctuation, A-Z lower-cased."""
    return (text or "").encode().lower().translate(_TO_SPACE).split()


def max_edits(m: int, share: float = EDIT_SHARE) -> int:
    return int(m * share + 1e-9)


def edit_distance(item: np.ndarray, stretch: np.ndarray) -> int:
    """Least edits between ``item`` and any part of ``stretch``; negative ids equal nothing."""
    at = np.arange(len(stretch) + 1)
    row = np.zeros(len(stretch) + 1, np.int64)
    for i, x in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[:-1] + (stretch != x), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


class Walks:
    """CGK walks: the key of a window under each repeat is made of the words written at the
    repeat's sampled steps. All repeats and windows advance together, a step at a time."""

    def __init__(self, repeats: int, sampled: int = SAMPLED, seed: int = 1):
        self.repeats, self.sampled, self.seed = repeats, sampled, seed
        self.taken: dict[int, np.ndarray] = {}

    def steps(self, m: int) -> np.ndarray:
        """(repeats, 2 m): which steps of windows of m words are sampled."""
        got = self.taken.get(m)
        if got is None:
            order = np.random.default_rng([self.seed, m]).random((self.repeats, 2 * m)).argsort(1)
            got = self.taken[m] = order < self.sampled
        return got

    def keys(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(repeats, windows): keys of the windows ``ids[start:start + size]``; ``ids`` has
        one more word after the last window."""
        out = np.empty((self.repeats, len(starts)), np.uint64)
        salt = np.arange(1, self.repeats + 1, dtype=np.uint64)[:, None] << np.uint64(32)
        with np.errstate(over="ignore"):
            together = max(1, min(WINDOWS, WALK_BYTES // (2 * self.repeats * int(sizes.max(initial=1)))))
            for at in range(0, len(starts), together):
                first, size = starts[at:at + together], sizes[at:at + together]
                last = 2 * int(size.max())
                taken = np.zeros((last, self.repeats, len(first)), bool)
                for m in np.unique(size):
                    taken[:2 * m, :, size == m] = self.steps(int(m)).T[:, :, None]
                move = np.zeros((self.repeats, len(first)), np.int64)
                key = mix(salt + size.astype(np.uint64))
                for j in range(last):
                    # past the window's end the word is -2, and the walk stays there
                    word = np.where(move < size, ids[np.minimum(first + move, len(ids) - 1)], -2)
                    hit = taken[j]
                    key[hit] = mix(key[hit] * M3 + (word[hit] + 3).astype(np.uint64))
                    turn = mix(salt + np.uint64(2 * (self.seed * 4096 + j) + 1)) | np.uint64(1)
                    move += ((mix((word + 3).astype(np.uint64)) * turn) >> np.uint64(63)).astype(np.int64)
                out[:, at:at + together] = key
        return out


class Index:
    """A block of items, ready for searching."""

    def __init__(self, items: list[tuple[int, list[bytes]]], share: float = EDIT_SHARE, sampled: int = SAMPLED, recall: float = RECALL,
                 min_words: int = MIN_WORDS):
        self.vocabulary: dict[bytes, int] = {}
        self.share = share
        numbered = [(i, np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)) for i, words in items]
        self.items = [(i, x) for i, x in numbered if len(x) >= min_words]
        self.levels = self._tree([(i, x) for i, x in numbered if 0 < len(x) < min_words])
        self.sizes = sorted({len(x) for _, x in self.items})
        # by pair: a bit for each size of the items that have it (sizes share 64 bits)
        self.pairs = np.zeros(1 << PAIR_BITS, np.uint64)
        self.least: dict[int, int] = {}  # by size: pairs that a window must hold
        for _, x in self.items:
            p, m = self._pair(x), len(x)
            self.pairs[p] |= np.uint64(1 << m % 64)
            # one less, as the window's first pair may equal the one before it
            self.least[m] = min(self.least.get(m, m), len(np.unique(p)) - 2 * max_edits(m, share) - 1)
        self.by_size: dict[int, list[int]] = {}
        for k, (_, x) in enumerate(self.items):
            self.by_size.setdefault(len(x), []).append(k)
        repeats = self.repeats_by_size(recall, sampled)
        self.exact = [m for m in self.sizes if repeats[m] is None]  # sizes without walks
        # sizes whose repeats round up to the same power of two walk together: (sizes, walks, sorted keys, their items)
        self.groups, at = [], {}
        for m in self.sizes:
            if repeats[m] is not None:
                at.setdefault(min(MOST_REPEATS, 1 << (repeats[m] - 1).bit_length()), []).append(m)
        for n, group in at.items():
            of = np.array([k for m in group for k in self.by_size[m]])
            walks = Walks(n, sampled)
            keys = walks.keys(*self._windows([self.items[k][1] for k in of]))
            order = np.argsort(keys, axis=None, kind="stable")
            self.groups.append((np.array(group), walks, keys.ravel()[order], of[order % len(of)]))

    def _tree(self, short: list[tuple[int, np.ndarray]]) -> list[tuple[np.ndarray, dict[int, list[int]]]]:
        """By depth: sorted keys (node above x words + next word), a node's number being its
        key's place, and the items that end in a node."""
        levels, node = [], np.zeros(len(short), np.int64)
        while short:
            keys = node * len(self.vocabulary) + np.array([x[len(levels)] for _, x in short])
            known, node = np.unique(keys, return_inverse=True)
            ends: dict[int, list[int]] = {}
            for k, (i, x) in zip(node.tolist(), short):
                if len(x) == len(levels) + 1:
                    ends.setdefault(k, []).append(i)
            levels.append((known, ends))
            longer = [len(x) > len(levels) for _, x in short]
            short, node = [s for s, more in zip(short, longer) if more], node[longer]
        return levels

    def verbatim(self, ids: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """(place of the text, item_id) of every short item in a text; negative ids end a text."""
        found, at, node = set(), np.flatnonzero(ids >= 0), 0
        for depth, (known, ends) in enumerate(self.levels):
            word = ids[at + depth]
            key = node * len(self.vocabulary) + word
            node = np.minimum(np.searchsorted(known, key), len(known) - 1)
            ok = (word >= 0) & (known[node] == key)
            at, node = at[ok], node[ok]
            last = np.isin(node, list(ends))
            doc = np.searchsorted(begin, at[last], "right") - 1
            for d, k in set(zip(doc.tolist(), node[last].tolist())):
                found.update((d, i) for i in ends[k])
        return found

    @staticmethod
    def _windows(texts: list[np.ndarray]):
        sizes = np.array([len(x) for x in texts], np.int64)
        ids = np.concatenate([np.append(x, -1) for x in texts] or [np.full(1, -1)])
        return ids, np.cumsum(sizes + 1) - sizes - 1, sizes

    @staticmethod
    def _pair(ids: np.ndarray) -> np.ndarray:
        """Places of the neighbouring words in ``pairs``."""
        return (ids[:-1] * 1_000_003 + ids[1:]) & ((1 << PAIR_BITS) - 1)

    def repeats_by_size(self, recall: float, sampled: int) -> dict[int, int | None]:
        """By item size: repeats that find edited copies, as far off as allowed, with ``recall``,
        even the one of CALIBRATE_COPIES that is hit least; None if MOST_REPEATS are too few."""
        rng, got = np.random.default_rng(7), {}
        walks = Walks(CALIBRATE_TRIALS, sampled, seed=2)
        for m in self.sizes:
            originals, copies = [], []
            for _ in range(CALIBRATE_COPIES):
                x = self.items[rng.choice(self.by_size[m])][1]
                copy = list(x)
                for _ in range(max_edits(m, self.share)):
                    at, what = rng.integers(len(copy)), rng.integers(3)
                    if what == 0:
                        copy[at] = -1
                    elif what == 1:
                        copy.insert(at, -1)
                    else:
                        del copy[at]
                originals.append(x)
                copies.append(np.array((copy + [-1] * m)[:m], np.int64))
            same = walks.keys(*self._windows(originals)) == walks.keys(*self._windows(copies))
            p = same.sum(0).min() / CALIBRATE_TRIALS
            n = 1 if p == 1 else int(np.ceil(np.log(1 - recall) / np.log(1 - p))) if p > 0 else None
            got[m] = n if n is not None and n <= MOST_REPEATS else None
        return got

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        """(place of the text, item_id, least edits) of every leak."""
        if not texts or not self.items and not self.levels:
            return []
        gap = max([len(self.levels), *self.sizes]) + 2
        known, parts, begin, ends, at = self.vocabulary, [], [], [], 0
        for t in texts:
            w = item_words(t)
            begin.append(at)
            ends.append(at + len(w))
            parts += [np.fromiter((known.get(x, -1) for x in w), np.int64, len(w)), np.full(gap, -1)]
            at += len(w) + gap
        ids, begin = np.concatenate(parts), np.array(begin)
        best: dict[tuple[int, int], int] = dict.fromkeys(self.verbatim(ids, begin), 0)
        pair = self._pair(ids)
        bits = self.pairs[pair] * ((ids[:-1] >= 0) & (ids[1:] >= 0))
        bits[1:] *= pair[1:] != pair[:-1]
        upto = np.zeros(len(ids), np.int32)  # pairs of any item before each word
        np.cumsum(bits > 0, out=upto[1:])
        places = []
        for m in self.sizes:
            at = np.flatnonzero(upto[m - 1:] - upto[:len(upto) - m + 1] >= self.least[m])
            own = np.zeros(len(at), np.int32)  # pairs of items of this size
            for i in range(m - 1 if len(at) else 0):
                own += (bits[at + i] >> np.uint64(m % 64) & np.uint64(1)).astype(np.int32)
            places.append(at[own >= self.least[m]])
        if not sum(map(len, places)):
            return [(doc, item, d) for (doc, item), d in sorted(best.items())]

        def text_at(start):
            doc = int(np.searchsorted(begin, start, "right")) - 1
            return doc + (start >= ends[doc])  # a window may start in the gap before its text

        def compare(doc, x, first, last):
            """Item ``x`` with the windows that start from ``first`` to ``last``."""
            item_id, item = self.items[x]
            e = max_edits(len(item), self.share)
            if best.get((doc, item_id)) != 0:
                d = edit_distance(item, ids[max(int(begin[doc]), first - e):min(ends[doc], last + len(item) + e)])
                if d <= e:
                    best[doc, item_id] = min(d, best.get((doc, item_id), d))

        place = dict(zip(self.sizes, places))
        for group, walks, keys, of in self.groups:
            starts, sizes = np.concatenate([place[m] for m in group]), np.repeat(group, [len(place[m]) for m in group])
            if not len(starts):
                continue
            k = walks.keys(ids, starts, sizes)
            low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
            found = set()
            for r, w in zip(*np.nonzero(high > low)):
                found.update((int(starts[w]), int(x)) for x in of[low[r, w]:high[r, w]])
            for start, x in sorted(found):
                doc = text_at(start)
                if doc < len(ends):
                    compare(doc, x, start, start)
        for m in self.exact:
            # windows of a text that overlap are one stretch
            runs: list[list[int]] = []
            for start in place[m].tolist():
                doc = text_at(start)
                if runs and runs[-1][0] == doc and start - runs[-1][2] <= m:
                    runs[-1][2] = start
                elif doc < len(ends):
                    runs.append([doc, start, start])
            for doc, first, last in runs:
                e = max_edits(m, self.share)
                near = pair[max(int(begin[doc]), first - e):min(ends[doc], last + m + e)]
                for x in self.by_size[m]:
                    p = np.unique(self._pair(self.items[x][1]))
                    if np.isin(p, near).sum() >= len(p) - 2 * e:
                        compare(doc, x, first, last)
        return [(doc, item, d) for (doc, item), d in sorted(best.items())]


def blocks(items: DataFrame, item_id: str, text: str, least_words: int, block_words: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items of at least ``least_words`` words, read block by block."""
    block, size = [], 0
    rows = items.filter(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).alias("i"), F.col(text).alias("t"))
    for row in rows.distinct().toLocalIterator():
        words = item_words(row["t"])
        if len(words) >= max(1, least_words):
            block.append((row["i"], words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def search_batch(index: Index, texts) -> list[tuple[int, int, int]]:
    """``Index.search`` over an Arrow column, some CHUNK_BYTES of text at once."""
    out, chunk, size, first = [], [], 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or size > CHUNK_BYTES:
            out += [(first + p, item, n) for p, item, n in index.search(chunk)]
            chunk, size, first = [], 0, i
        if i < len(texts):
            t = texts[i].as_py()
            chunk.append(t)
            size += len(t or "")
    return out


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
          min_words: int = MIN_WORDS, share: float = EDIT_SHARE, sampled: int = SAMPLED, recall: float = RECALL,
          block_words: int = BLOCK_WORDS, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, item_id, edits): every document and item that leaks into it, with the least
    edits found, one row per document row and item.

    Null or empty text: no leak. Items of fewer than ``min_words`` words leak verbatim only,
    with 0 edits. Items that are null, have a null id or fewer than ``least_words`` words (at
    least 1) are not searched for; items with equal ids each count. Repeated
    document rows give repeated result rows, null ids come out as null. Without documents
    or items the result is empty. Other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def one(block) -> DataFrame:
        shared = spark.sparkContext.broadcast(Index(block, share, sampled, recall, min_words))  # block_words bounds it

        def search(batches):
            for b in batches:
                ids = b.column("doc_id").to_pylist()
                out = [(ids[p], item, n) for p, item, n in search_batch(shared.value, b.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["doc_id", "item_id", "edits"])

        return d.mapInArrow(search, RESULT)

    parts = [one(b) for b in blocks(items, item_id, item_text, least_words, block_words)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RESULT)


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  min_words: int = MIN_WORDS, share: float = EDIT_SHARE, sampled: int = SAMPLED, recall: float = RECALL,
                  block_words: int = BLOCK_WORDS, least_words: int = DROP_WORDS) -> DataFrame:
    """``docs`` without the rows that an item leaks into, all columns kept; the cases are
    those of ``leaks``. No shuffle: each block of items is one pass over the rows left."""
    spark, at = docs.sparkSession, [c.lower() for c in docs.columns].index(text.lower())
    for block in blocks(items, item_id, item_text, least_words, block_words):
        shared = spark.sparkContext.broadcast(Index(block, share, sampled, recall, min_words))

        def clean(batches, shared=shared):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[p for p, _, _ in search_batch(shared.value, b.column(at))]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
