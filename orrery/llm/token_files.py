"""Token ids in binary record files, in document order, with an offset index.

Writing: documents are range-sorted by id; every task encodes the texts of its range and
writes them to record files of its own (see ``records``). The index, a table of its own,
has a row per record: file, offset, length, document and the number of ids before it in the
whole corpus. File names carry a random part, so a task that runs again writes other files
and the index only names those of the attempt that counted.

Reading: any selection of index rows in any order. A task takes rows up to a number of
bytes, reads neighbouring ranges of a file together, checks lengths and checksums, and
returns the sequences in the order that was asked for.

A record's data: 8 bytes document id, 1 byte whether it has one, 1 byte bytes per id,
2 zero bytes, 4 bytes number of ids, then the ids, all little-endian.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import struct
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table, scratch_path
from orrery.llm.records import Corrupt, frame, unframe
from orrery.llm.text_batches import Numbers, often, parts, record_batch, take_runs
from orrery.llm.warc import _store

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
FILE_BYTES = 256 << 20
PART_BYTES = 2 << 20  # of text encoded at once
KNOWN_WORDS = 400_000  # remembered per Python worker
JOINED_WORDS = 500  # encoded together
MERGE_GAP = 64 << 10
READ_BYTES = 8 << 20
TASK_BYTES = 64 << 20
HEADER = struct.Struct("<qBBHI")
INDEX = "part int, shard int, file string, offset long, length long, doc_id long, n_tokens long, before long"


@lru_cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# letters that normal forms leave alone and lower-casing maps to one letter, then punctuation:
# one piece or two
PLAIN_WORD, MARKS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+|[.,;:!?]+"), ".,;:!?"


class Encoder:
    """Ids of texts by a tokenizer that treats words between white space on their own, so
    that a distinct word is encoded once (up to ``most`` are remembered).

    Plain words are encoded by their lower-case letters and their punctuation, many of these
    together, parted by spaces: where the vocabulary marks the ends of pieces, they tell them
    apart again. If they don't, and for other words, each is encoded by itself.
    """

    def __init__(self, path: str, most: int = KNOWN_WORDS):
        self.tokenizer, self.most = tokenizer(path), most
        said = json.loads(self.tokenizer.to_str())
        suffix = said["model"].get("end_of_word_suffix")
        # plain words are in lower case and normal form already
        self.plain = type(self.tokenizer).from_str(json.dumps(said | {"normalizer": None}))
        if self.tokenizer.normalizer is None or self.tokenizer.normalizer.normalize_str("AÉĴ,") != "aéĵ,":
            suffix = None
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tokenizer.get_vocab().items() if suffix else ():
            self.ends[i] = token.endswith(suffix)
        self.stems: dict[str, bytes | None] = {}
        self.known, self.flat = Numbers(), np.zeros(0, np.uint32)
        self.starts, self.sizes, self.uses = (np.zeros(0, np.int64) for _ in range(3))

    def _forget(self):
        """All words but the more frequent ones."""
        chosen = often(self.uses, self.most // 2)
        self.known.keep(chosen)
        self.flat = take_runs(self.flat, self.starts[chosen], self.sizes[chosen])
        self.sizes = self.sizes[chosen]
        self.starts, self.uses, self.stems = np.cumsum(self.sizes) - self.sizes, np.zeros(len(chosen), np.int64), {}

    def _ids(self, texts: list[str], by=None) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in (by or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_stems(self, stems: list[str]) -> None:
        """Words of one piece each; None for others."""
        plain = [s for s in stems if PLAIN_WORD.fullmatch(s)] if self.ends.any() else []
        self.stems.update(dict.fromkeys(stems))
        groups = [plain[i:i + JOINED_WORDS] for i in range(0, len(plain), JOINED_WORDS)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups], self.plain)):
            ends = (np.flatnonzero(self.ends[np.frombuffer(ids, np.uint32)]) + 1) * 4
            if len(ends) == len(group) and ends[-1] == len(ids):
                ends = ends.tolist()
                self.stems.update(zip(group, [ids[i:j] for i, j in zip([0, *ends], ends)]))
            else:
                self.stems.update(zip(group, self._ids(group, self.plain)))

    def _learn(self, words: list[bytes]) -> None:
        texts = b"\n".join(words).decode()
        low, texts = texts.lower().split("\n"), texts.split("\n")
        cut = [w.rstrip(MARKS) for w in low]
        marks = [w[len(s):] for w, s in zip(low, cut)]
        self._learn_stems(list(set(cut).union(marks).difference(self.stems)))
        found = list(map(self.stems.__getitem__, cut))
        for i, m in enumerate(marks):
            if m and found[i] is not None:
                found[i] += self.stems[m]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self._ids([texts[i] for i in rest])):
            found[i] = ids
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes, self.uses = np.append(self.sizes, sizes), np.append(self.uses, np.zeros_like(sizes))
        self.flat = np.append(self.flat, np.frombuffer(b"".join(found), np.uint32))

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        split = [(t or b"").split() for t in texts]
        if len(self.known) > self.most:
            self._forget()
        counts = [len(w) for w in split]
        at = self.known.of(chain.from_iterable(split), sum(counts))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        self.uses += np.bincount(at, minlength=len(self.uses))
        sizes = self.sizes[at]
        ids = take_runs(self.flat, self.starts[at], sizes)
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)[:-1]] if counts else []
        return np.split(ids, edges)


@lru_cache
def encoder(path: str) -> Encoder:
    """One per Python worker: what it has learned serves all its tasks."""
    return Encoder(path)


def serialize(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return HEADER.pack(doc_id or 0, doc_id is not None, width, 0, len(ids)) + ids.astype(f"<u{width}").tobytes()


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, has, width, _, n = HEADER.unpack_from(data)
    if width not in (2, 4) or len(data) != HEADER.size + n * width:
        raise Corrupt("a record's number of ids does not match its length")
    return doc_id if has else None, np.frombuffer(data, f"<u{width}", n, HEADER.size).astype("<u4")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def write_sequences(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None, doc_id: str = "doc_id",
                    text: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of every whole text below ``path`` and return the index, a written table:
    file, offset, length, doc_id, n_tokens and start (ids of all documents before it).

    Documents are in ascending order of id, those without one first; rows that repeat an id
    are records of their own, in an order fixed by their texts. ``end_id`` is appended to
    every document. Null or empty text: no other ids. An empty table writes no file and
    returns an empty index. The tokenizer must treat words between white space on their
    own, as those that drop white space do.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]  # ranges are found from a sample of these: no texts
    d = d.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    schema = _schema(INDEX)

    def write(batches):
        store, root = _store(path)
        part = TaskContext.get().partitionId()
        out, name, shard, offset, before = None, None, -1, 0, 0
        try:
            for b in parts(batches, "text", PART_BYTES):
                keys = b.column("doc_id").to_pylist()
                ids = encoder(tokenizer_path).encode(b.column("text").cast(pa.binary()).to_pylist())
                if end_id is not None:
                    ids = [np.append(x, np.uint32(end_id)) for x in ids]
                rows = []
                for key, x, record in zip(keys, ids, frame([serialize(k, x) for k, x in zip(keys, ids)])):
                    if out is None or offset + len(record) > file_bytes:
                        if out is not None:
                            out.close()
                        else:
                            store.create_dir(root, recursive=True)
                        shard, offset, before = shard + 1, 0, 0
                        name = f"tokens-{part:06d}-{shard:04d}-{uuid.uuid4().hex}.rec"
                        out = store.open_output_stream(posixpath.join(root, name), compression=None)
                    out.write(record)
                    rows.append((part, shard, name, offset, len(record), key, len(x), before))
                    offset, before = offset + len(record), before + len(x)
                yield record_batch(schema, list(zip(*rows)))
        finally:
            if out is not None:
                out.close()

    index = materialize(d.mapInArrow(write, INDEX), "index")
    # one row per file: ids before it
    files = index.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))
    return materialize(index.join(files, ["part", "shard"])
                            .select("file", "offset", "length", "doc_id", "n_tokens", (F.col("file_start") + F.col("before")).alias("start")), "index")


def by_place(selected: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Index rows dealt to tasks by stretches of files, for reads of everything."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // task_bytes + 1)
    return (selected.repartition(tasks, "file", F.floor(F.col("offset") / task_bytes))
                    .sortWithinPartitions("file", "offset"))


def shuffled(selected: DataFrame, seed: int, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Index rows in a random order fixed by ``seed``, dealt to tasks by ranges of it."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // task_bytes + 1)
    order = [F.xxhash64(F.lit(seed), "file", "offset"), "file", "offset"]
    return selected.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def read_sequences(selected: DataFrame, path: str, merge_gap: int = MERGE_GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """doc_id, start, ids (little-endian 4-byte integers) of the records that the index rows
    ``selected`` name, in their order within each task.

    A task takes rows up to ``read_bytes`` bytes of records at a time and reads ranges of a
    file that lie at most ``merge_gap`` apart together. A record whose length or checksum
    does not match fails the job (``records.Corrupt``). A row selected twice is returned twice.
    """
    out_schema = _schema("doc_id long, start long, ids binary")

    def read(batches):
        store, root = _store(path)
        source, opened = None, None

        def fetch(rows):
            nonlocal source, opened
            raw, run = [None] * len(rows), []

            def flush():
                nonlocal source, opened
                file, low, high = rows[run[0]][0], rows[run[0]][1], max(rows[i][1] + rows[i][2] for i in run)
                if opened != file:
                    if source is not None:
                        source.close()
                    source, opened = store.open_input_file(posixpath.join(root, file)), file
                data = source.read_at(high - low, low)
                for i in run:
                    raw[i] = data[rows[i][1] - low:rows[i][1] - low + rows[i][2]]
                run.clear()

            for i in sorted(range(len(rows)), key=lambda i: rows[i][:2]):
                if run and (rows[i][0] != rows[run[-1]][0] or rows[i][1] > rows[run[-1]][1] + rows[run[-1]][2] + merge_gap):
                    flush()
                run.append(i)
            flush()
            got = [parse(x) for x in unframe(raw)]
            return record_batch(out_schema, [[k for k, _ in got], [r[3] for r in rows], [x.tobytes() for _, x in got]])

        try:
            rows, size = [], 0
            for b in batches:
                for row in zip(*[b.column(c).to_pylist() for c in ("file", "offset", "length", "start")]):
                    if rows and size + row[2] > read_bytes:
                        yield fetch(rows)
                        rows, size = [], 0
                    rows.append(row)
                    size += row[2]
            if rows:
                yield fetch(rows)
        finally:
            if source is not None:
                source.close()

    return selected.select("file", "offset", "length", "start").mapInArrow(read, "doc_id long, start long, ids binary")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    index = write_sequences(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=END_ID)
    got = read_sequences(by_place(index), path)
    return got.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.crc32("ids").cast("long").alias("ids_crc32"))
