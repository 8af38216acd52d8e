"""Token files, token alignment and phrase mining against plain versions of the same."""

import bisect
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orrery.llm import phrases, records, token_align, token_files
from orrery.llm.common import scratch_path
from test_operators import COLS, LONG, SF, docs_of, rows

WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), COLS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLS)


# --- record files

def plain_crc32c(data):
    c = 0xFFFFFFFF
    for x in data:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (records.POLYNOMIAL if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_checksums_equal_the_plain_ones():
    rnd = random.Random(1)
    messages = [b"123456789"] + [rnd.randbytes(n) for n in (4, 5, 63, 64, 65, 127, 128, 129, 4097, *(rnd.randrange(4, 3000) for _ in range(20)))]
    got = records.crc32c(np.frombuffer(b"".join(messages), np.uint8), np.array([len(m) for m in messages]))
    assert got[0] == 0xE3069283 and got.tolist() == [plain_crc32c(m) for m in messages]
    assert records.unframe(records.frame(messages)) == messages and records.frame([]) == records.unframe([]) == []


def test_changed_records_are_refused():
    good = records.frame([b"some data", b"other data"])
    for at in (0, 9, 14, len(good[1]) - 1):
        bad = bytearray(good[1])
        bad[at] ^= 1
        with pytest.raises(records.Corrupt):
            records.unframe([good[0], bytes(bad)])
    with pytest.raises(records.Corrupt):
        records.unframe([good[0][:-1]])


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=st.one_of(st.sampled_from("KÅẞİſaB’'s.é́  \x1c\x85İﬁ<|>endoftx \t\n\x0b12漢"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_words_encoded_on_their_own_equal_the_whole_text(text):
    for t in (text, f"{text} <|endoftext|>{text}"):
        assert token_files.encoder(WORD).encode([t.encode()])[0].tolist() == token_files.tokenizer(WORD).encode(t, add_special_tokens=False).ids


def test_forgetting_changes_nothing():
    texts = [f"The word{i % 7}x, and Été{i} it's {i} {'naïve!' * (i % 3)} the." for i in range(200)]
    few, token = token_files.Encoder(WORD, most=40), token_align.Tokens(BYTE, PIECE, most=30)
    for i in range(0, 200, 10):
        some = texts[i:i + 10]
        assert [x.tolist() for x in few.encode([t.encode() for t in some])] == [e.ids for e in few.tokenizer.encode_batch(some, add_special_tokens=False)]
        (a, n_a), (b, n_b) = token.encode(some)
        assert [x.tolist() for x in np.split(a, np.cumsum(n_a)[:-1])] == token.encode_a([" " + t for t in some])
        assert [x.tolist() for x in np.split(b, np.cumsum(n_b)[:-1])] == token.encode_b(some)
    assert len(few.known) < 80 and len(token.known) < 80


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=st.one_of(st.sampled_from("KÅẞİſaB’'s.é  \x1c\x85\xa0▁<|>endoftx \t\n12漢"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_segments_encoded_on_their_own_equal_the_whole_text(text):
    by = token_align.tokens(BYTE, PIECE)
    for t in (text, f"{text} <|endoftext|> <s>{text}"):
        (a, _), (b, _) = by.encode([t])
        x, y = by.encode_a([" " + t])[0], by.encode_b([t])[0]
        good = t and b"".join(by.bytes_a[i] for i in x) == (" " + t).encode() == b"".join(by.bytes_b[i] for i in y)
        assert (a.tolist(), b.tolist()) == ((x, y) if good else ([], []))


def plain_ids(texts):
    return [np.array(e.ids + [2], "<u4") for e in Tokenizer.from_file(WORD).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_equal_plain_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows_ = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = sorted(map(tuple, token_files.op12_token_files(spark, SF).collect()))
    start, want = 0, []
    for (i, _), ids in zip(rows_, plain_ids([t for _, t in rows_])):
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_token_files_selection_order_and_odd_rows(spark, odd, nothing):
    path = scratch_path(spark, "tokens")
    index = token_files.write_sequences(odd, path, WORD, end_id=2, file_bytes=2000)
    place = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in index.collect())
    assert [p[0] for p in place] == list(np.cumsum([0] + [p[1] for p in place])[:-1])
    assert [p[2] for p in place] == [None, None, 1, 2, 3, 4, 5, 6, 6, 6, 7] and index.select("file").distinct().count() > 2
    got = collections.defaultdict(list)
    for r in token_files.read_sequences(token_files.by_place(index), path).collect():
        got[r["doc_id"]].append(np.frombuffer(r["ids"], "<u4").tolist())
    texts = {i: t for i, t, *_ in rows() if i not in (6, None)}
    for i, t in texts.items():
        assert got[i] == [plain_ids([t])[0].tolist()]
    assert got[1] == got[2] == got[3] == [[2]] and len(got[5][0]) > 60_000 and len(got[6]) == 3
    chosen = index.filter("doc_id in (4, 6, 7)").orderBy("start")
    few = [token_files.read_sequences(token_files.shuffled(chosen, seed), path).collect() for seed in (1, 1, 2)]
    assert few[0] == few[1] and sorted(few[0]) == sorted(few[2]) and len(few[0]) == 5
    assert token_files.read_sequences(chosen.coalesce(1), path).select("doc_id").collect() == chosen.select("doc_id").collect()
    assert token_files.write_sequences(nothing, scratch_path(spark, "tokens"), WORD).count() == 0


def test_wide_ids_and_damaged_data():
    for ids in ([], [1, 65535], [1, 65536]):
        assert token_files.parse(token_files.serialize(None, np.array(ids, np.uint32)))[1].tolist() == ids
    data = token_files.serialize(-5, np.array([1, 2], np.uint32))
    assert token_files.parse(data)[0] == -5
    with pytest.raises(records.Corrupt):
        token_files.parse(data[:-1])


# --- alignment

def plain_alignment(text):
    (encode_a, bytes_a), (encode_b, bytes_b) = token_align.byte_level(BYTE), token_align.piece_level(PIECE)
    a, b = (encode_a([" " + text])[0], encode_b([text])[0]) if text else ([], [])
    x, y = [bytes_a[i] for i in a], [bytes_b[i] for i in b]
    if b"".join(x) != (" " + (text or "")).encode() or b"".join(y) != b"".join(x):
        return [], [], [], []
    ends = [[sum(map(len, z[:i + 1])) for i in range(len(z))] if len(z) < 500 else list(np.cumsum(list(map(len, z)))) for z in (x, y)]
    groups, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        to = [bisect.bisect_right(z, e) for z in ends]
        groups.append((a[i:to[0]], b[j:to[1]]))
        i, j = to
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((i, j))
        e, f = ends[0][i], ends[1][j]
        i, j = i + (e <= f), j + (f <= e)
    return a, b, groups, links


def plain_scores(texts):
    done = [plain_alignment(t) for t in texts]
    n = collections.Counter()
    for a, b, _, links in done:
        n.update({(a[i], b[j]) for i, j in links})
    highest = collections.defaultdict(int)
    for (x, _), c in n.items():
        highest[x] = max(highest[x], c)
    out = []
    for a, b, groups, links in done:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        held = [(a[i], b[j]) for i, j in links]
        out.append((len(a), len(b), len(groups), len(links), sum(n[p] == highest[p[0]] for p in held), sum(n[p] for p in held),
                    hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return out


STRANGE = [None, "", " ", "  two  spaces ", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ the sign for a space", "naïve café 漢字 😀 ‍\x00", "a\tb\nc", "é ﬁ",
           "supercalifragilisticexpialidocious" * 3, "0123456789" * 9, "!!!???...", "Ġ the byte sign"]


@pytest.mark.parametrize("chunk_links", [1, 3000, 1 << 22])
def test_link_scores_equal_plain_counting(spark, chunk_links):
    texts = STRANGE + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    got = token_align.link_scores(docs_of(spark, texts), BYTE, PIECE, chunk_links=chunk_links).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == plain_scores(texts)
    assert [r["n_a"] > 0 for r in sorted(got)[:6]] == [False, False, True, True, True, False]


def test_alignment_in_full(spark):
    texts = STRANGE + [LONG]
    for r in token_align.align(docs_of(spark, texts), BYTE, PIECE).collect():
        a, b, groups, links = plain_alignment(texts[r["doc_id"]])
        assert (r["a_ids"], r["b_ids"]) == (a, b) and list(zip(r["group_a"], r["group_b"])) == [(len(x), len(y)) for x, y in groups]
        assert list(zip(r["link_a"], r["link_b"])) == links


def test_alignment_odd_rows(odd, nothing):
    got = token_align.link_scores(odd, BYTE, PIECE).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got) == sorted((r[0] is None, r[0]) for r in rows())
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert all(tuple(by[i][0])[1:] == (0, 0, 0, 0, 0, 0, "") for i in (1, 2)) and by[5][0]["n_a"] >= 60_000
    assert len({r["groups_sha256"] for r in [*by[6], *by[7]]}) == 2
    assert token_align.link_scores(nothing, BYTE, PIECE).count() == 0 == token_align.align(nothing, BYTE, PIECE).count()


# --- phrases

def plain_phrases(docs, max_words, min_count, percent):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = []
    for p, a in found.items():
        lang, w = p[0], p[1:]
        score, _, left, right = min((10 ** 6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
        longer = max([b for q, b in found.items() if q[0] == lang and len(q) > len(p) and any(q[i:i + len(w)] == w for i in range(1, len(q)))], default=0)
        out.append((lang, " ".join(w), a, left, right, n[lang], score, longer, bool(longer) and 100 * longer >= percent * a))
    return sorted(out)


@pytest.mark.parametrize("max_words, min_count, chunk_words, segments", [(3, 3, 1 << 20, 1), (3, 2, 40, 64), (4, 2, 300, 16), (2, 2, 100, 1000)])
def test_phrases_equal_plain_counting(spark, max_words, min_count, chunk_words, segments):
    rnd = random.Random(max_words)
    words = ["the", "The", "of", "a\xa0b", "New", "York", "naïve", "漢字", "x-y", "\x1c"] + [f"w{i}" for i in range(12)]
    text = lambda: "".join(rnd.choice(words[:3] if rnd.random() < 0.4 else words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(60))
    docs = [(rnd.choice(["en", "de", None]), rnd.choice([text(), "The New York of the", None, "", " . "])) for _ in range(60)]
    frame = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(docs)], "doc_id long, text string, lang string")
    got = phrases.phrases(frame, max_words, min_count, chunk_words=chunk_words, segments=segments)
    want = plain_phrases(docs, max_words, min_count, 50)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 30
    ranked = collections.defaultdict(list)
    for r in sorted(phrases.best(got, 7).collect(), key=lambda r: r["rank"]):
        ranked[r["lang"]].append((r["rank"], r["phrase"]))
    for g in {w[0] for w in want}:
        mine = sorted((w for w in want if w[0] == g and not w[8]), key=lambda w: (-w[6], -w[2], w[1].encode()))
        assert ranked[g] == [(i + 1, w[1]) for i, w in enumerate(mine[:7])]


def test_scores_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_000, 4_000_000_000_000, 5_000_000_000_000
    cell = spark.createDataFrame([(a, left, right)], "a long, l long, r long").selectExpr(
        "cast(cast(1000000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(a as decimal(38,0)) as decimal(38,0)) div cast(cast(l as decimal(38,0)) * cast(r as decimal(38,0)) as decimal(38,0)) as s")
    assert cell.first()["s"] == 10 ** 6 * a * a // (left * right)


def test_phrases_odd_rows(odd, nothing):
    got = phrases.phrases(odd, min_count=2)
    by = {(r["lang"], r["phrase"]): r for r in got.collect()}
    assert by["en", "alpha beta"]["a"] == 6 and by["de", "theta iota kappa"]["a"] == 3 and by["en", "w0 w1"]["a"] == 61
    assert phrases.phrases(nothing).count() == 0 and phrases.best(phrases.phrases(nothing)).count() == 0
