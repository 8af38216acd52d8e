"""Phrase collocations of a corpus by stripes.

A stripe is a prefix of words with a counter of the words that follow it; what follows the
last word of a piece is the empty word, so a stripe's total is the prefix's own count. The
stripes of all prefixes with the same first word are one row.

1. ``word_counts``: the stripe of the empty prefix per language, one row per word.
2. ``stripes``: tasks count the prefixes of part of the texts. Words that are too rare for
   any candidate end a piece here (those that a bitmap of fixed size tells; the others only
   cost space). Rows of first words that hold many of all occurrences are cut into segments
   by a hash of the following word, as many as that share asks for, so that no task gets a
   whole hot word.
3. ``merged``: equal prefixes meet and their counters are added elementwise. A merged
   stripe gives its prefix's total, the counts of its extensions and, by the largest of
   them, how much of the prefix goes on in a longer phrase.
4. Candidates get the counts of their parts, the score of their worst cut, and go if a
   longer candidate holds most of their occurrences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table
from orrery.llm.text_batches import parts, record_batch

MAX_WORDS = 3
MIN_COUNT = 10
SUBSUMED_PERCENT = 50
SCALE = 1_000_000
TOP = 2_000
CHUNK_WORDS = 1 << 20  # counted together in a task
PART_BYTES = 4 << 20
ROWS_OUT = 20_000  # of a batch given out
SEGMENTS_PER_PARTITION = 4
BITMAP_BITS = 24  # 2 MB, whatever the corpus: fuller bitmaps keep more rare words

# fixed characters: those that end a piece, and those that end a word in it
PIECE_ENDS, WORD_ENDS = ".,;:!?\n\x0b\x0c\r", " \t"
_CUT = bytes.maketrans((PIECE_ENDS + WORD_ENDS).encode(), b"." * len(PIECE_ENDS) + b" " * len(WORD_ENDS))
END = b"."  # can't be a word; place 0 of every vocabulary


class Chunks:
    """Texts as word numbers per language, given out when they hold ``most`` words in all."""

    def __init__(self, most: int):
        self.most, self.size, self.langs = most, 0, {}

    def add(self, lang: str, text: str) -> None:
        known, numbers = self.langs.setdefault(lang, ({END: 0}, []))
        w = text.encode().lower().translate(_CUT).replace(b".", b" . ").split()
        if w:
            new = set(w).difference(known)
            known.update(zip(new, range(len(known), len(known) + len(new))))
            numbers.append(np.fromiter(map(known.__getitem__, w), np.int64, len(w)))
            numbers.append(np.zeros(1, np.int64))
            self.size += len(w) + 1

    def full(self) -> bool:
        return self.size >= self.most

    def take(self):
        """(lang, vocabulary, numbers) of all languages; 0 ends a piece."""
        out = [(lang, pa.array(known, pa.binary()).cast(pa.string()), np.concatenate(numbers))
               for lang, (known, numbers) in self.langs.items() if numbers]
        self.size, self.langs = 0, {}
        return out


def _chunks(batches, most: int):
    c = Chunks(most)
    for b in parts(batches, "text", PART_BYTES):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            c.add(lang, text)
            if c.full():
                yield from c.take()
    yield from c.take()


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
                .filter("text is not null"))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """lang, word, n: occurrences of every word."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        for name, vocabulary, numbers in _chunks(batches, chunk_words):
            n = np.bincount(numbers, minlength=len(vocabulary))[1:]
            yield record_batch(schema, [pa.repeat(pa.scalar(name), len(n)), vocabulary[1:], pa.array(n)])

    counted = _texts(docs, text, lang).mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """What ``xxhash64(lang, word)`` gives in Spark."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def word_bitmap(words: DataFrame, bits: int = BITMAP_BITS) -> bytes:
    """Bits set at the hashes of ``words`` (lang, word), least first: the driver gets
    2 ** bits bits, whatever the number of words."""
    at = F.expr(f"pmod(xxhash64(lang, word), {1 << bits}) + 1")
    rows = words.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m"))
    out = bytearray(1 << (bits - 3))
    for r in rows.collect():
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = r["m"]
    return bytes(out[:1 << (bits - 3)])


def _stripes_of(lang: str, vocabulary: pa.Array, x: np.ndarray, k: int, heavy: dict[int, int], bitmap: bytes, schema: pa.Schema):
    """The stripes of all prefixes of ``k`` words in one chunk, a row per first word and segment."""
    v = len(vocabulary)
    hashes = _word_hashes(lang, vocabulary.cast(pa.binary()).to_pylist())
    bits = np.frombuffer(bitmap, np.uint8)
    at = hashes & np.uint64(len(bits) * 8 - 1)
    frequent = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    frequent[0] = False
    x = np.append(np.where(frequent[x], x, 0), np.zeros(k + 1, np.int64))
    at = np.flatnonzero(np.logical_and.reduce([x[i:len(x) - k + i] != 0 for i in range(k)]))
    if not len(at):
        return
    prefix, heads = np.zeros(len(at), np.int64), np.zeros((1, 0), np.int64)
    for i in range(k):  # number the distinct prefixes, a word longer each time; 0 can't go on
        codes, prefix = np.unique(prefix * v + x[at + i], return_inverse=True)
        heads = np.column_stack([heads[codes // v], codes % v])
    codes = np.sort(prefix * v + x[at + k])
    new = np.flatnonzero(np.diff(codes, prepend=-1))
    counts, (prefix, following) = np.diff(new, append=len(codes)), np.divmod(codes[new], v)
    # segments of frequent first words
    n_parts = np.array([heavy.get(h, 1) for h in hashes.tolist()], np.int64) if heavy else np.ones(v, np.int64)
    segment = np.zeros(len(prefix), np.int64)
    split = np.flatnonzero(n_parts[heads[prefix, 0]] > 1)
    if len(split):
        segment[split] = hashes[following[split]] % n_parts[heads[prefix[split], 0]].astype(np.uint64)
        order = np.lexsort((following, prefix, segment, heads[prefix, 0]))
        prefix, following, segment, counts = prefix[order], following[order], segment[order], counts[order]
    first = heads[prefix, 0]
    row = np.flatnonzero(np.diff(first, prepend=-1) | np.diff(segment, prepend=-1))  # first entry of each row
    stripe = np.flatnonzero(np.diff(prefix, prepend=-1) | np.diff(segment, prepend=-1))  # and of each stripe
    words = pa.concat_arrays([pa.array([""]), vocabulary[1:]]).cast(pa.large_string())
    space, tab = pa.scalar(" ", pa.large_string()), pa.scalar("\t", pa.large_string())
    take = lambda at: words.take(pa.array(at))
    joined = lambda flat, starts, by: pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.append(starts, len(flat))), flat), by)
    rests = pc.binary_join_element_wise(*[take(heads[prefix[stripe], i]) for i in range(1, k)], space) if k > 1 else pa.repeat(pa.scalar("", pa.large_string()), len(stripe))
    in_row = np.searchsorted(stripe, row)
    nexts = joined(joined(take(following), stripe, space), in_row, tab)
    rests = joined(rests, in_row, tab)
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.append(row, len(prefix)) * 4), pa.py_buffer(counts.astype("<u4"))])
    key, segment, is_split = take(first[row]), pa.array(segment[row].astype(np.int32)), pa.array(n_parts[first[row]] > 1)
    for i in range(0, len(row), ROWS_OUT):
        out = [x[i:i + ROWS_OUT] for x in (key, segment, is_split, rests, nexts, packed)]
        yield record_batch(schema, [pa.repeat(pa.scalar(lang), len(out[0])), *[x.cast(f.type) for x, f in zip(out, list(schema)[1:])]])


def stripes(docs: DataFrame, words: int, heavy: dict[int, int], bitmap: bytes, text: str = "text", lang: str = "lang",
            chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Stripes of parts of the texts, of all prefixes of ``words`` words with the same first
    word: lang, first, segment, split (whether there are several segments), rests (the further
    words of each prefix, tabs between prefixes), nexts (the words that follow it, space-joined,
    the empty word for the end of a piece; tabs as before), counts of all of these
    (little-endian 4-byte integers). ``heavy``: number of segments by hash of a first word;
    ``bitmap``: hashes of the words that don't end a piece, see ``word_bitmap``."""
    schema = pa.schema([("lang", pa.string()), ("first", pa.string()), ("segment", pa.int32()), ("split", pa.bool_()),
                        ("rests", pa.string()), ("nexts", pa.string()), ("counts", pa.binary())])

    def cut(batches):
        for name, vocabulary, numbers in _chunks(batches, chunk_words):
            yield from _stripes_of(name, vocabulary, numbers, words, heavy, bitmap, schema)

    return _texts(docs, text, lang).mapInArrow(cut, "lang string, first string, segment int, split boolean, rests string, nexts string, counts binary")


class _Entries:
    """Entries of stripes: word that follows, number, and place of its prefix among ``lang``,
    ``prefix``, ``split`` and ``h`` (arrays with one item per stripe of each chunk)."""

    def __init__(self, lang, prefix, split, h, of, following, n):
        self.lang, self.prefix, self.split, self.h, self.of, self.following, self.n = lang, prefix, split, h, of, following, n

    @classmethod
    def read(cls, b: pa.RecordBatch, words: int):
        of_row, prefix = (lambda x: (pc.list_parent_indices(x), x.flatten()))(pc.split_pattern(b.column("rests"), "\t"))
        nexts = pc.split_pattern(pc.split_pattern(b.column("nexts"), "\t").flatten(), " ")
        first = b.column("first").take(of_row)
        prefix = pc.binary_join_element_wise(first, prefix, " ") if words > 1 else first
        n = np.frombuffer(b"".join(b.column("counts").to_pylist()), "<u4").astype(np.int64)
        return cls(b.column("lang").take(of_row), prefix, b.column("split").take(of_row), b.column("h").take(of_row).to_numpy(),
                   pc.list_parent_indices(nexts).to_numpy(), nexts.flatten(), n)

    def after(self, held: "_Entries | None") -> "_Entries":
        if held is None:
            return self
        join = lambda x, y: pa.concat_arrays([x, y])
        return _Entries(join(held.lang, self.lang), join(held.prefix, self.prefix), join(held.split, self.split), np.append(held.h, self.h),
                        np.append(held.of, self.of + len(held.h)), join(held.following, self.following), np.append(held.n, self.n))

    def added(self) -> "_Entries":
        """Equal entries of equal prefixes added up, sorted by prefix."""
        lang, prefix = self.lang.dictionary_encode(), self.prefix.dictionary_encode()
        code = lang.indices.to_numpy().astype(np.int64) * len(prefix.dictionary) + prefix.indices.to_numpy()
        _, at, code = np.unique(code, return_index=True, return_inverse=True)
        word = self.following.dictionary_encode()
        key = code[self.of] * len(word.dictionary) + word.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        n = np.add.reduceat(self.n[order], starts) if len(starts) else self.n
        of, words = np.divmod(key[order[starts]], max(1, len(word.dictionary)))
        pick = pa.array(at)
        return _Entries(self.lang.take(pick), self.prefix.take(pick), self.split.take(pick), self.h[at], of, word.dictionary.take(pa.array(words)), n)

    def where(self, keep: np.ndarray) -> "_Entries":
        """Those of the prefixes ``keep``."""
        entries, pick = keep[self.of], pa.array(np.flatnonzero(keep))
        place = np.cumsum(keep) - 1
        return _Entries(self.lang.take(pick), self.prefix.take(pick), self.split.take(pick), self.h[keep], place[self.of[entries]],
                        self.following.filter(pa.array(entries)), self.n[entries])


def merged(striped: DataFrame, words: int, min_count: int) -> DataFrame:
    """lang, prefix, total, nexts, counts: stripes (or their segments) added elementwise, with
    the extensions that occur ``min_count`` times; whole stripes whose total is smaller are
    left out."""
    # rows are dealt and sorted by a hash that isn't sent along
    h = F.xxhash64("lang", "first", "segment")
    keyed = striped.repartition(h).withColumn("h", h).sortWithinPartitions("h")
    schema = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("total", pa.int64()),
                        ("nexts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def finish(e: _Entries) -> pa.RecordBatch:
        total = np.bincount(e.of, e.n, minlength=len(e.h)).astype(np.int64)
        keep = (total >= min_count) | e.split.to_numpy(zero_copy_only=False)
        frequent = (e.n >= min_count) & pc.not_equal(e.following, "").to_numpy(zero_copy_only=False)
        # stripes that go have no frequent entries
        size = np.bincount(e.of[frequent], minlength=len(e.h))[keep]
        offsets, pick = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(np.flatnonzero(keep))
        return record_batch(schema, [e.lang.take(pick), e.prefix.take(pick), pa.array(total[keep]),
                                     pa.ListArray.from_arrays(offsets, e.following.filter(pa.array(frequent))),
                                     pa.ListArray.from_arrays(offsets, pa.array(e.n[frequent]))])

    def merge(batches):
        held = None  # entries of the last hash, added up
        for b in batches:
            if b.num_rows:
                e = _Entries.read(b, words).after(held).added()
                last = e.h == b.column("h")[b.num_rows - 1].as_py()
                held = e.where(last)
                if not last.all():
                    yield finish(e.where(~last))
        if held is not None:
            yield finish(held)

    return keyed.select("h", "lang", "first", "split", "rests", "nexts", "counts").mapInArrow(
        merge, "lang string, prefix string, total long, nexts array<string>, counts array<long>")


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang",
                  chunk_words: int = CHUNK_WORDS, segments: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f of all phrases of up to ``max_words`` words that occur
    ``min_count`` times; lang, n of all words), both written tables."""
    words = materialize(word_counts(docs, text, lang, chunk_words), "words")
    totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    # at most ``segments`` words hold 1 / segments of all occurrences
    segments = segments or SEGMENTS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = words.filter(F.col("n") * segments > n).collect() if segments > 1 else []
    heavy = {int(_word_hashes(r["lang"], [r["word"].encode()])[0]): -(-r["n"] * segments // n) for r in frequent}
    bitmap = word_bitmap(words.filter(F.col("n") >= min_count))
    counts = words.filter(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("f"))
    # prefixes of k words give phrases of k (totals) and k + 1 words (extensions)
    for k in range(max_words - 1, 0, -2):
        got = materialize(merged(stripes(docs, k, heavy, bitmap, text, lang, chunk_words), k, min_count), "stripes")
        extended = got.select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
        counts = counts.unionByName(extended.select("lang", F.concat_ws(" ", "prefix", "e.nexts").alias("phrase"), F.lit(k + 1).alias("size"), F.col("e.counts").alias("f")))
        if k > 1:
            counts = counts.unionByName(got.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f"))
                                           .filter(F.col("f") >= min_count).select("lang", "phrase", F.lit(k).alias("size"), "f"))
    return materialize(counts, "phrases"), totals


def _slice(words: Column, start, length) -> Column:
    return F.concat_ws(" ", F.slice(words, start, length))


def phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, subsumed_percent: int = SUBSUMED_PERCENT,
            scale: int = SCALE, text: str = "text", lang: str = "lang", chunk_words: int = CHUNK_WORDS, segments: int | None = None) -> DataFrame:
    """Every phrase of 2 to ``max_words`` words that occurs ``min_count`` times within pieces,
    per language: lang, phrase, a, l, r, n, score, in_longer (occurrences of the most frequent
    longer candidate that holds it, 0 without one), subsumed.

    A-Z lower-cased; pieces end at ``.,;:!?`` and code points 10 to 13, words at space and
    tab. A cut after the first words gives l and r, the counts of both parts, and the score
    floor(scale * a * a / (l * r)) (numbers of 38 digits); the lowest-scoring cut counts, the
    shortest first part among equals. Null language: ``und``. Null, empty or wordless texts
    count nothing; repeated rows count each; an empty table gives no rows. Other columns
    are not read.
    """
    counts, totals = phrase_counts(docs, max_words, min_count, text, lang, chunk_words, segments)
    several = counts.filter("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = several.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.select("lang", "phrase", "size", F.col("f").alias("a"), "k", _slice(F.col("w"), F.lit(1), F.col("k")).alias("first"),
                       _slice(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    cuts = cuts.withColumns({"b": big("a"), "lr": (big("l") * big("r")).cast("decimal(38,0)")})
    cuts = cuts.withColumn("score", F.expr(f"cast(cast({scale} as decimal(38,0)) * b * b as decimal(38,0)) div lr"))
    worst = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    # occurrences inside longer candidates
    inner = several.filter("size > 2").select("lang", "w", "size", "f", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inner = inner.select("lang", "w", "m", "f", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i"))
    held = (inner.groupBy("lang", _slice(F.col("w"), F.col("i"), F.col("m")).alias("phrase")).agg(F.max("f").alias("in_longer")))
    out = worst.join(held, ["lang", "phrase"], "left").withColumn("in_longer", F.coalesce("in_longer", F.lit(0)))
    out = out.join(totals, "lang")
    return out.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"), "in_longer",
                      ((F.col("in_longer") > 0) & (100 * F.col("in_longer") >= subsumed_percent * F.col("a"))).alias("subsumed"))


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language that aren't subsumed, with their rank.

    Parts of a language are ranked first, so that the last ranking of a language takes at
    most ``top`` rows of each part."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    kept = found.filter(~F.col("subsumed"))
    parts_of = max(1, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    for n in (parts_of, 1):
        w = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(n))).orderBy(*order)
        kept = kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return kept.withColumn("rank", F.col("rank").cast("long"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases(read_table(spark, sf_dir, "documents"))
    return best(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, w[i] || CASE WHEN k > 1 THEN ' ' || w[i + 1] ELSE '' END || CASE WHEN k > 2 THEN ' ' || w[i + 2] ELSE '' END AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT a.lang, a.phrase, a.f AS a, x.k AS cut, x.f AS l, y.f AS r, 1000000 * a.f * a.f // (x.f * y.f) AS score
      FROM f a JOIN f x ON x.lang = a.lang AND x.k < a.k AND x.phrase = array_to_string(a.w[:x.k], ' ')
               JOIN f y ON y.lang = a.lang AND y.k = a.k - x.k AND y.phrase = array_to_string(a.w[x.k + 1:], ' ')),
d AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM c),
t AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM f WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM f WHERE k = 3),
m AS (SELECT lang, phrase, max(f) AS f FROM t GROUP BY ALL),
s AS (SELECT d.lang, d.phrase, d.a, d.l, d.r, d.score FROM d LEFT JOIN m USING (lang, phrase)
      WHERE d.place = 1 AND (m.f IS NULL OR 100 * m.f < 50 * d.a)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
SELECT o.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
