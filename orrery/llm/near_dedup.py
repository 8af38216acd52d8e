"""MinHash near-duplicates by bands of signature coordinates.

1. A document's shingle set gives a signature of minima. Documents with equal sets (by a
   128-bit digest) form one class; classes are what is compared below.
2. The minima are cut into bands of ``WIDTH`` (fewer at a low similarity), and each band
   is a posting. There are so many bands that two classes whose sets have the similarity
   asked for agree in one but for a probability below ``MISS``, while classes that only
   share some shingles hardly ever do. Bands that occur once collide with nothing and are
   dropped.
3. Short posting lists are expanded into their pairs. Pairs of too different size or that
   agree in too few minima are skipped, the others are compared on their full sets.
4. In a long list, classes are paired with one pivot, not with each other, and of its
   pivots a class takes the one it collides with most often; links are merged into
   components. With other pivots this repeats for lists that still hold several components,
   until few are left or a round leaves more than half of the pairs.
5. What is open then is compared in blocks: the classes of the long lists are dealt to
   blocks, those of a list's main component to blocks of their own, and two blocks that
   meet in a list are compared in one task, all sets of one with all of the other, unless
   they are of one component. So no link between different components is lost, no list is
   expanded into all its pairs, and a task holds two blocks. Full sets are made only of
   classes that share a posting.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table
from orrery.llm.components import components
from orrery.llm.shingles import M3, Hasher, mix, shingles

MISS = 1e-6
WIDTH = 4  # minima per band
ROUNDS = 4
OPEN_PAIRS = 16  # pairs per list entry up to which a list is expanded into its pairs
BLOCK, BLOCK_SHINGLES = 256, 1 << 16  # classes and shingles of a block, about; one class at least
COLUMNS = 4096  # shingles by which two blocks are multiplied at a time


def min_matches(coords: int, percent: int, miss: float = MISS) -> int:
    """Largest t with P(Binomial(coords, percent/100) < t) <= miss (at least 1)."""
    p, t, below = percent / 100, 0, 0.0
    while t < coords:
        below += math.comb(coords, t) * p ** t * (1 - p) ** (coords - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def banding(percent: int, miss: float = MISS) -> tuple[int, int]:
    """(minima per band, minima per signature, a multiple of 4): sets of the similarity share
    no band with a probability of at most ``miss``."""
    p = percent / 100
    width = WIDTH if p >= 0.7 else 2 if p >= 0.4 else 1
    bands = 1 if p >= 1 else math.ceil(math.log(miss) / math.log1p(-p ** width))
    return width, 4 * -(-bands * width // 4)


def row_key(doc_id, text):
    """128-bit key of a row's id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("\n"), F.coalesce(text, F.lit("")))))


def signatures(docs: DataFrame, n: int, coords: int) -> DataFrame:
    """doc_id, row_key, n_shingles, node (128-bit digest of the set), sig (16 bits of each
    of the ``coords`` minima, four in a long) per row of (doc_id, text, row_key); node and
    sig are null for an empty set."""
    seeds = (mix(np.arange(1, coords + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
    kinds = [("doc_id", pa.int64()), ("row_key", pa.binary()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("sig", pa.list_(pa.int64()))]

    def minima(s):
        s, low = (s >> np.uint64(32)).astype(np.uint32), None
        for i in range(0, len(s), 1024):
            x = s[i:i + 1024] * seeds
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            low = x.min(1) if low is None else np.minimum(low, x.min(1))
        # minima are small numbers: mixed before 16 bits are kept
        return (mix(low.astype(np.uint64) * M3) >> np.uint64(48)).astype("<u2").view("<i8")

    def sign(batches):
        hasher = Hasher()
        for b in batches:
            size, node, sig = [], [], []
            for text in b.column("text"):
                s = shingles(hasher.words(text.as_py()), n)
                size.append(len(s))
                node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                with np.errstate(over="ignore"):
                    sig.append(minima(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_key").cast(pa.binary()), pa.array(size, pa.int64()),
                                              pa.array(node, pa.binary()), pa.array(sig, pa.list_(pa.int64()))], schema=pa.schema(kinds))

    return docs.select("doc_id", "text", "row_key").mapInArrow(
        sign, "doc_id long, row_key binary, n_shingles long, node binary, sig array<long>")


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """(node, set) per row of (node, text): the sorted shingle hashes as bytes."""

    def sets(batches):
        hasher = Hasher()
        for b in batches:
            got = [shingles(hasher.words(t.as_py()), n).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("node").cast(pa.binary()), pa.array(got, pa.binary())], names=["node", "set"])

    return docs.select("node", "text").mapInArrow(sets, "node binary, set binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
                 .join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b"))

    def similar(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            kept = b.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a").cast(pa.binary()), kept.column("b").cast(pa.binary())], names=["a", "b"])

    return full.select("a", "b", "set_a", "set_b").mapInArrow(similar, "a binary, b binary")


def block_links(percent: int):
    """Task function: the rows (side, node, component, set) of two blocks, or of one → (a, b)
    that connect what links between different components connect."""

    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.array([len(s) for s in sets])

    def run(rows: pa.Table) -> pa.Table:
        nodes = rows.column("node").to_pylist()
        known: dict = {}
        comp = np.array([known.setdefault(c, len(known)) for c in rows.column("component").to_pylist()])
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in rows.column("set")]
        side = rows.column("side").to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):
            right = left
        (x, i, nx), (y, j, ny) = flat([sets[k] for k in left]), flat([sets[k] for k in right])
        shared = np.intersect1d(x, y)
        both = np.zeros((len(left), len(right)))
        for k in range(0, len(shared), COLUMNS):
            part = shared[k:k + COLUMNS]

            def has(v, row, n):
                at = np.minimum(np.searchsorted(part, v), len(part) - 1)
                ok = part[at] == v
                m = np.zeros((n, len(part)), np.float32)
                m[row[ok], at[ok]] = 1
                return m

            both += has(x, i, len(left)) @ has(y, j, len(right)).T
        both = both.astype(np.int64)
        link = (100 * both >= percent * (nx[:, None] + ny[None, :] - both)) & (comp[left][:, None] != comp[right][None, :])
        # the least row that links lead to
        least, far = np.arange(len(nodes)), len(nodes)
        while True:
            now = least.copy()
            now[left] = np.minimum(now[left], np.where(link, now[right][None, :], far).min(1))
            now[right] = np.minimum(now[right], np.where(link, now[left][:, None], far).min(0))
            if (now == least).all():
                break
            least = now
        moved = np.flatnonzero(least != np.arange(len(nodes)))
        return pa.table({"a": pa.array([nodes[k] for k in moved], pa.binary()), "b": pa.array([nodes[k] for k in least[moved]], pa.binary())})

    return run


def blockwise(p: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) that connect what links between different components of the lists ``p``
    (token, node, component, m, main, all) connect."""
    # a class goes with its longest list, apart if it is of the main component there
    home = (p.groupBy("node").agg(F.first("component").alias("component"), F.first("m").alias("m"), F.max(F.struct("all", "token", "main")).alias("h"))
             .select("node", "component", "m", F.when(F.col("component") == F.col("h.main"), F.col("component")).alias("pure"), F.col("h.token").alias("home"))
             .withColumn("part", F.xxhash64("home", "pure")))
    dealt = home.groupBy("part").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("m") / BLOCK_SHINGLES)).alias("n"))
    placed = materialize(home.join(dealt, "part").select(
        "node", "component", "pure", F.xxhash64("part", F.pmod(F.xxhash64(F.lit(-1), "node"), "n")).alias("block")), "placed")
    met = p.select("token", "node").join(placed, "node").select("token", "block", "pure").distinct()
    a, b = met.select("token", F.col("block").alias("x"), F.col("pure").alias("px")), met.select("token", F.col("block").alias("y"), F.col("pure").alias("py"))
    pairs = materialize(a.join(b, "token").filter((F.col("x") <= F.col("y")) & F.coalesce(F.col("px") != F.col("py"), F.lit(True)))
                         .select("x", "y").distinct(), "blocks")
    members = materialize(placed.join(sets, "node").select("block", "node", "component", "set"), "members")
    left = pairs.withColumn("side", F.lit(0)).withColumn("block", F.col("x"))
    right = pairs.filter("x < y").withColumn("side", F.lit(1)).withColumn("block", F.col("y"))
    return left.unionByName(right).join(members, "block").select("x", "y", "side", "node", "component", "set").groupBy("x", "y").applyInArrow(
        block_links(percent), "a binary, b binary")


def postings(nodes: DataFrame, width: int) -> DataFrame:
    """(token, node, m, df): each class under those bands of its signature that others share,
    and how many classes have the band."""
    bits = 16 * width
    part = lambda v, k: v if bits == 64 else F.shiftrightunsigned(v, bits * k).bitwiseAND(F.lit((1 << bits) - 1))
    tokens = F.flatten(F.transform("sig", lambda v, i: F.array(*[F.xxhash64(i, F.lit(k), part(v, k)) for k in range(64 // bits)])))
    t = nodes.select("node", "m", F.explode(tokens).alias("token"))
    seen = t.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    return t.join(seen, "token").select("token", "node", "m", "df")


def classes(docs: DataFrame, n: int, coords: int) -> tuple[DataFrame, DataFrame]:
    """The signed documents and one row per class of equal sets: node, n_shingles, sig, and
    the id and key of the row that represents it."""
    signed = materialize(signatures(docs, n, coords), "signed")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row_key").alias("key"))
    nodes = (signed.filter("node is not null").groupBy("node")
                   .agg(F.min(first).alias("first"), F.first("n_shingles").alias("m"), F.first("sig").alias("sig"))
                   .select("node", "m", "sig", F.col("first.id").alias("first_id"), F.col("first.key").alias("first_key")))
    return signed, materialize(nodes, "nodes")


def linked(posted: DataFrame, test, sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """(node, component) by links that share a list of ``posted`` (token, node, m, df) and have
    sizes m that allow the similarity. Links pass ``test`` (pairs a, b → those that do) or,
    in long lists after ``rounds`` of pivots, are found on the ``sets`` of whole blocks.
    Nodes without a link may be missing."""
    fits = F.least("mx", "my") * 100 >= F.greatest("mx", "my") * percent
    side = lambda d, x: d.select("token", *[F.col(c).alias(to + x) for c, to in (("node", ""), ("component", "c"), ("m", "m")) if c in d.columns])
    ordered = lambda d: d.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    short = F.col("df") <= 2 * OPEN_PAIRS + 1
    some = posted.filter(short)
    edges = materialize(test(ordered(side(some, "x").join(side(some, "y"), "token").filter((F.col("x") < F.col("y")) & fits))), "links")
    p = posted.filter(~short)
    for r in range(0 if p.isEmpty() else rounds + 1):
        label = materialize(components(edges, rounds=2), "label")  # enough to see what is open
        # only lists that were open can be open again
        p = p.select("token", "node", "m").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        # lists that hold several components, and the component most of a list is in
        per = p.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
        lists = (per.groupBy("token").agg(F.max(F.struct("k", "component")).alias("main"), F.sum("k").alias("all"), F.count(F.lit(1)).alias("comps"))
                    .filter("comps > 1").select("token", F.col("main.component").alias("main"), "all"))
        p = materialize(p.join(lists, "token"), "open")
        size = p.agg(F.sum(F.when(F.col("component") != F.col("main"), F.col("all"))).alias("pairs"), F.count(F.lit(1)).alias("rows")).first()
        if not size["rows"]:
            break
        if r == rounds or (r > 0 and 2 * size["pairs"] > before):
            edges = edges.unionByName(materialize(blockwise(p, sets, percent), "links"))
            break
        before = size["pairs"]
        b = side(p, "y")
        pivot = b.groupBy("token").agg(F.min(F.struct(F.xxhash64(F.lit(r), "y").alias("h"), "y", "cy", "my")).alias("v")).select("token", "v.*")
        pairs = side(p, "x").join(pivot, "token").filter((F.col("cx") != F.col("cy")) & fits)
        # of a class's pivots, the one it collides with most often
        pairs = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("hits")).groupBy("x").agg(F.max(F.struct("hits", "y")).alias("v"))
        edges = edges.unionByName(materialize(test(ordered(pairs.select("x", F.col("v.y").alias("y")))), "links"))
    return components(edges)


def links(docs: DataFrame, nodes: DataFrame, n: int, percent: int, coords: int, width: int, rounds: int = ROUNDS) -> DataFrame:
    """(node, component) for every class that links with another; ``component`` is a node."""
    matches = min_matches(coords, percent)
    posted = materialize(postings(nodes, width), "postings")
    brief = materialize(nodes.join(posted, "node", "left_semi").select("node", "sig", F.col("first_key").alias("row_key")), "brief")
    texts = docs.select("row_key", "text").join(brief.select("node", "row_key"), "row_key").dropDuplicates(["row_key"])
    sets = materialize(shingle_sets(texts, n), "sets")
    lanes = lambda x: sum((F.shiftrightunsigned(x, 16 * k).bitwiseAND(F.lit(0xFFFF)) == 0).cast("int") for k in range(4))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda have, x: have + lanes(x))

    def similar(pairs: DataFrame) -> DataFrame:
        p = (pairs.join(brief.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
                  .join(brief.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b"))
        return confirm(p.filter(same >= matches).select("a", "b"), sets, percent)

    return linked(posted, similar, sets, percent, rounds)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80,
                    coords: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key (see there), n_shingles, component_id, kept.

    ``component_id`` is the smallest id of the documents reachable by links of at least
    ``percent`` percent Jaccard similarity, the document itself included; ``kept`` is
    doc_id = component_id. Null or wordless text: no shingles, linked with nothing.
    Repeated rows and ids are rows of their own. Null ids are never the smallest: a
    component of none but null ids has a null component_id and all its rows kept. An
    empty table gives an empty result. Other columns are not read. ``coords`` minima are
    taken per set, or as many as ``percent`` asks for if that is more or it is not given.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must lie in (0, 100]")
    width, enough = banding(percent)
    coords = max(enough, 4 * -(-(coords or 0) // 4))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                    row_key(F.col(doc_id), F.col(text)).alias("row_key"))
    signed, nodes = classes(d, n, coords)
    label = links(d, nodes, n, percent, coords, width, rounds)
    first = nodes.select("node", "first_id").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = first.groupBy("component").agg(F.min("first_id").alias("component_id"))
    first = first.join(smallest, "component").select(F.col("node").alias("__node"), "component_id")
    out = signed.join(first, signed.node == first["__node"], "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "row_key", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), n=2).drop("row_key")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id,
  coalesce(c.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY ALL) c USING (doc_id)
"""
