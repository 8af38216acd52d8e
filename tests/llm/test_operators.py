"""Each training-data operator: defined edge cases, and brute force where SQL can't express it."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import decontaminate, html_text, line_dedup, lm_score, mixing, near_dedup, pii, quality, toxicity, warc
from orrery.llm.common import running_sum, scratch_path
from orrery.llm.components import components

SF = "/root/testdata/sf0.001"
COLS = "doc_id long, text string, lang string, source string, n_chars long, key string, size long, component string, severity string, n_removed int, `__x` int"
LONG = " ".join(f"w{i % 997}" for i in range(60_000))
PROSE = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3


def rows():
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and ids."""
    base = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b ", None, "b"), (4, "word", "en", None), (None, "a null id", "en", "a"),
            (None, None, None, None), (5, LONG, "en", "a"), (6, PROSE, "en", "a"), (6, PROSE, "en", "a"), (6, "same id, other text", "en", "b"),
            (7, PROSE, "de", "b")]
    return [(*r, None, "k", 9, "c", "s", 3, 1) for r in base]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), COLS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLS)


def docs_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source if isinstance(source, str) else source[i]) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")


def test_running_sum_equals_prefix_sums(spark):
    data = [(g, i, (i * 7) % 5) for g, n in ((None, 40), ("a", 200), ("b", 1)) for i in range(n)]
    got = running_sum(spark.createDataFrame(data, "g string, i int, v long"), ["g"], ["i"], "v", "s").collect()
    for g in (None, "a", "b"):
        mine = sorted((r["i"], r["v"], r["s"]) for r in got if r["g"] == g)
        assert [x[2] for x in mine] == list(np.cumsum([x[1] for x in mine]))
    assert len(got) == len(data)


def test_components_equal_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    loops = {a for a, b in edges if a == b}
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in root if x not in loops or any(x in e and e[0] != e[1] for e in edges)}


# --- quality

def test_quality_edge_cases(odd, nothing):
    got = quality.judge(odd).collect()
    assert len(got) == 11 and quality.judge(nothing).count() == 0
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i in (1, 2, 3):
        assert (by[i][0]["n_words"], by[i][0]["base_failed"], by[i][0]["kept"]) == (0, True, False)
    assert by[5][0]["n_words"] == 60_000 and by[5][0]["n_repeat_words"] == 60_000
    assert [r["n_repeat_words"] for r in by[7]] == [30]


def test_bucket_is_exact_below_64_and_close_above(spark):
    values = list(range(200)) + [10 ** 6 + 17, 2 ** 40 + 12345]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket_low(quality.bucket(F.col("v"))).alias("low")).collect()
    for r in got:
        assert r["low"] <= r["v"] < r["low"] * (1 + 1 / 32) + 1
        assert r["v"] >= 64 or r["low"] == r["v"]


def test_quality_rejects_outliers_of_their_group_only(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8)))
    texts = [" ".join(word() for _ in range(80)) for _ in range(300)]
    junk = [" ".join(word() + "%%%###" for _ in range(80)) for _ in range(5)]
    got = quality.judge(docs_of(spark, texts + junk)).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == set(range(300, 305))
    assert all("symbol_rate" in r["outside"] for r in got if r["doc_id"] >= 300)


# --- line dedup

def test_line_dedup_edge_cases(odd, nothing):
    got = line_dedup.remove_spread_lines(odd)
    assert got.columns == [*odd.columns, "n_spread", "n_removed_"]
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert line_dedup.remove_spread_lines(nothing).count() == 0


def test_line_dedup_cuts_spread_lines_and_spares_copies(spark):
    own = [f"first line of text {i}, its own\nsecond line of text {i}, its own" for i in range(8)]
    texts = [f"{t}\n All rights reserved. " for t in own] + ["a whole page\ncopied to many sites"] * 8 + [None, "on five sites\nown"]
    texts += ["on five sites\nanother thing"] * 4
    sites = [f"s{i % 8}" for i in range(16)] + ["s1", "s0", "s1", "s2", "s3", "s4"]
    got = {r["doc_id"]: r for r in line_dedup.remove_spread_lines(docs_of(spark, texts, sites), min_sites=6).collect()}
    for i in range(8):
        assert (got[i]["text"], got[i]["n_spread"], got[i]["n_removed"]) == (own[i], 1, 1)
        assert (got[8 + i]["text"], got[8 + i]["n_spread"], got[8 + i]["n_removed"]) == (texts[8], 2, 0)
    assert got[16]["text"] is None and got[17]["text"] == texts[17]


# --- personal data

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def fits(kind, v):
        d = re.sub("[^0-9]", "", v)
        double = sum((x if i % 2 == 0 else x * 2 - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d))))
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in v.split(".")), "card": 13 <= len(d) <= 19 and double % 10 == 0,
                "phone": 9 <= len(d) <= 15}[kind]

    return [(k, m.start(), m.end()) for k, p in RULES.items() for m in re.finditer(p, text or "") if fits(k, m[0])]


def test_pii_base_equals_plain_matching(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["1", "23", "4111", "1111 1111", "-", " ", ".", "..", "@", "a.b", "+", "(", ")", "é", "x", "255.", "0.0.0.0", "\n", "😀"])
                     for _ in range(60)) for _ in range(300)]
    texts += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "x" * 50_000 + "@", "4" * 40, "4111 1111 1111 1111", "+1 (017) 555-7713 +++1 2 3", "1.2.3.256 1.2.3.0255",
              "a." * 20_000 + "@b" + ".c" * 20_000]
    got = {r["doc_id"]: r["found"] for r in pii.find(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert [(x["kind"], x["start"], x["end"]) for x in got[i] if x["base"]] == base_spans(t), repr(t)[:200]


def test_pii_model_adds_secrets_and_keeps_apart(spark):
    rnd = random.Random(9)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    texts = [f'some words, token = "{key()}" and more' for _ in range(40)]
    texts += [f"see release_notes_of_the_version_{i} there" for i in range(40)] + ["mail me: long-name-1234567890abcdef@example.com now"]
    got = {r["doc_id"]: [(x["kind"], x["start"], x["end"]) for x in r["found"]] for r in pii.find(docs_of(spark, texts)).collect()}
    assert all(got[i] == [("secret", 21, 61)] for i in range(40))
    assert all(got[i] == [] for i in range(40, 80))
    assert [k for k, _, _ in got[80]] == ["email"]


def test_pii_edge_cases(odd, nothing):
    assert all(r["found"] == [] for r in pii.find(odd).collect()) and pii.find(odd).count() == 11
    assert pii.find(nothing).count() == 0


def test_em_recovers_reliabilities():
    rnd = random.Random(2)
    counts = collections.Counter()
    truth = collections.defaultdict(list)
    for _ in range(4000):
        y = rnd.random() < 0.4
        v = tuple((1 if (rnd.random() < acc) == y else -1) if rnd.random() < 0.8 else 0 for acc in (0.95, 0.8, 0.7, 0.6, 0.55))
        counts["k", v] += 1
        truth[v].append(y)
    p = pii.estimate([(k, v, n) for (k, v), n in counts.items()])
    right = sum(n * (np.mean(truth[v]) if p[k, v] >= 0.5 else 1 - np.mean(truth[v])) for (k, v), n in counts.items()) / 4000
    assert right > 0.85 and pii.estimate([]) == {}


# --- WARC

def test_warc_round_trip_and_selection(spark):
    big = "<p>" + "payload é😀 " * 30
    data = [(3, "http://x/ü\r\nX: y", big), (1, None, big), (1, None, big), (None, "http://n", big), (7, "u", None), (8, "u", ""), (9, "u", "small"), (10, "u", "small")]
    pages = spark.createDataFrame([(*r, "k") for r in data], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc-test")
    index = warc.write_archives(pages, path, archive_bytes=700)
    got = warc.read_records(index, path).collect()
    digest = lambda s: hashlib.sha256((s or "").encode()).hexdigest()
    want = [(3, big, "revisit", 1), (1, big, "response", None), (1, big, "response", None), (None, big, "revisit", 1)]
    want += [(i, s, "response", None) for i, _, s in data[4:]]
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(
        ((i, len((s or "").encode()), digest(s), kind, to) for i, s, kind, to in want), key=str)
    assert all(r["payload"].decode() == big for r in got if r["page_id"] == 1)
    assert index.select("file").distinct().count() > 1
    one = warc.read_records(index.filter("page_id = 9"), path).collect()
    assert [bytes(r["payload"]) for r in one] == [b"small"]
    empty = warc.write_archives(pages.limit(0), scratch_path(spark, "warc-test"))
    assert empty.count() == 0 and warc.read_records(empty, path).count() == 0


# --- LM scores

def plain_scores(texts, order, alpha=0.4, least=2):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for t in texts]
    c = collections.Counter(tuple(w[i:i + k]) for w in words for k in range(1, order + 1) for i in range(len(w) - k + 1))
    n, out = sum(map(len, words)), []
    for w in words:
        total, short = 0, 0
        for i in range(len(w)):
            cost, k = 0.0, min(order, i + 1)
            short += not (k == order and c[tuple(w[i - k + 1:i + 1])] >= least)
            while k > 1 and c[tuple(w[i - k + 1:i + 1])] < least:
                cost, k = cost + math.log(alpha), k - 1
            g = tuple(w[i - k + 1:i + 1])
            total += round((math.log(c[g] / (c[g[:-1]] if k > 1 else n)) + cost) * 1e6)
        out.append((len(w), short, total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_equal_plain_counting(spark, order):
    rnd = random.Random(order)
    texts = [" ".join(rnd.choice("a B c dd E".split()) for _ in range(rnd.randint(0, 40))) for _ in range(60)] + [None, "", "a", "only here", LONG]
    got = lm_score.scores(docs_of(spark, texts), order=order, chunk_words=200, partition_words=500).collect()
    want = plain_scores(texts, order)
    for r in got:
        n, short, total = want[r["doc_id"]]
        assert r["n_words"] == n and abs(r["log_score"] - total) <= n
        assert order == 1 or r["n_backoff"] == short


def test_lm_edge_cases(odd, nothing):
    got = lm_score.scores(odd).collect()
    assert len(got) == 11 and sorted(r["n_words"] for r in got)[:4] == [0, 0, 0, 0] and lm_score.scores(nothing).count() == 0


# --- near duplicates

def plain_components(texts, n, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        k = min(n, len(w))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()

    s = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(s))], [len(x) for x in s]


@pytest.mark.parametrize("rounds", [1, 4])
def test_near_duplicates_equal_brute_force(spark, rounds, monkeypatch):
    monkeypatch.setattr(near_dedup, "OPEN_PAIRS", 0 if rounds > 1 else 1000)  # all rounds of pivots, or straight to the rest
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for size in (3, 8, 30, 60, 120):
        for _ in range(4):
            base = [rnd.choice(vocabulary) for _ in range(size)]
            for _ in range(8):  # chains of copies, some of copies
                base = list(base)
                for _ in range(rnd.randint(0, max(1, size // 14))):
                    base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
                texts.append(" ".join(base))
    texts += ["of the"] * 5 + ["the", "The", None, "", "  ", "of the of the"]
    rnd.shuffle(texts)
    want, sizes = plain_components(texts, 2, 80)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs_of(spark, texts), n=2, rounds=rounds).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i]["kept"] == (want[i] == i) for i in range(len(texts)))


def test_near_duplicates_post_only_what_is_alike(spark, monkeypatch):
    """Texts that share frequent word pairs, but aren't alike, share hardly any posting."""
    rnd, posted, write = random.Random(5), [], near_dedup.materialize

    def counted(df, label):
        out = write(df, label)
        posted.extend([out.count()] if label == "postings" else [])
        return out

    monkeypatch.setattr(near_dedup, "materialize", counted)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rnd.choice(words) for _ in range(80)) for _ in range(200)]
    texts += [" ".join(t.split()[:-1] + ["end"]) for t in texts[:10]]  # and ten that are
    want, _ = plain_components(texts, 2, 80)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs_of(spark, texts), n=2).collect()}
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) == 200
    assert sum(posted) < 5 * len(texts)


@pytest.mark.parametrize("block", [7, 1000])
def test_near_duplicates_compare_a_dense_group_in_blocks(spark, monkeypatch, block):
    """Near copies of one text, half of them too far from the others: few pairs are compared one by one."""
    rnd, compared, confirm = random.Random(6), [], near_dedup.confirm

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return confirm(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "confirm", counted)
    monkeypatch.setattr(near_dedup, "OPEN_PAIRS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", block, raising=False)
    monkeypatch.setattr(near_dedup, "COLUMNS", 64, raising=False)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(120):
        copy = list(base)
        for k in rnd.sample(range(120), rnd.choice([3, 4, 8, 9])):
            copy[k] = f"e{i}w{k}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{i}w{k}" for k in range(40)) for i in range(5)]
    want, _ = plain_components(texts, 2, 80)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs_of(spark, texts), n=2).collect()}
    assert [got[i] for i in range(len(texts))] == want and 2 < len(set(want)) < len(texts)
    assert sum(compared) < 1000


@pytest.mark.parametrize("percent", [20, 50, 80, 95, 100])
def test_banding_meets_its_bound(percent):
    width, coords = near_dedup.banding(percent)
    assert coords % 4 == 0 and (1 - (percent / 100) ** width) ** (coords // width) <= near_dedup.MISS


def test_near_duplicates_edge_cases(odd, nothing):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == 11 and near_dedup.near_duplicates(nothing).count() == 0
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] in (6, 7)) == [
        (6, 6, True), (6, 6, True), (6, 6, True), (7, 6, False)]
    assert {(r["n_shingles"], r["kept"]) for r in got if r["doc_id"] in (1, 2, 3)} == {(0, True)}


def test_min_matches():
    t = near_dedup.min_matches(32, 80)
    assert sum(math.comb(32, k) * 0.8 ** k * 0.2 ** (32 - k) for k in range(t)) <= 1e-6 and 10 <= t <= 20


# --- HTML

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>a<p>b", "a\nb"), ("plain &amp; text", "plain & text"), ("<!-- open <p>x</p>", ""),
    ("<script>var t='</p>';</script><p>one</p>", "one"), ("<p>a&nbsp;b<br>c</p>", "a b c"), ("<p>cut <b", "cut <b"),
    ("<nav><a href=x>menu</a></nav><article><h1>T</h1><p>Some, text, here.</p></article><footer>c</footer>", "T\nSome, text, here."),
    ("<div class='ad'>buy</div><div><p>Prose of the page, long enough, with commas.</p><div id=comments><p>me, too, I say, and so on, at length</p></div></div>",
     "Prose of the page, long enough, with commas."),
    ("<article><p>First, long paragraph of it.</p><ul><li><a href=a>go</a><li><a href=b>there</a></ul><ul><li>kept item</ul></article>",
     "First, long paragraph of it.\nkept item"),
    # ambiguous names inside the article, and the same ones where they mean what isn't
    ("<article><div class='entry-header'><h1>Title</h1></div><h2 class='section-header'>Part</h2><p class='social-history'>She drank, at times.</p>"
     "<p class='alert alert-info'>Mind this, reader.</p><span class='search'>word</span><div class=post-nav><a href=a>Back</a> <a href=b>On</a></div>"
     "<div class='notice'>Notice of the site.</div><p class=ad>Buy</p></article>",
     "Title\nPart\nShe drank, at times.\nMind this, reader.\nword"),
    ("<div class=site-header><p>Site, with a name, of some length.</p></div><div><p>Prose of the page, long enough, with commas.</p></div>",
     "Prose of the page, long enough, with commas."),
    ("<p>The sum <math><semantics><mrow><mi>a</mi><mo>+</mo><mn>1</mn></mrow><annotation>a+1</annotation></semantics></math> is it.</p>", "The sum a+1 is it."),
    # beside an article
    ("<h4>Before</h4><article><p>First, long paragraph of it, as it is.</p></article><p>The end.</p><p><a href=x>more</a></p>",
     "Before\nFirst, long paragraph of it, as it is.\nThe end."),
    ("<div><article><p>One article, of some length, stands here.</p></article></div><section><article><p>Two.</p></article></section>"
     "<article class=comment><p>I, too, want to say, well, something.</p></article>", "One article, of some length, stands here.\nTwo."),
    ("<nav><a href=n>Home</a></nav><p><a href=x>Only linked text here</a></p><ul><li><a href=y>go</a></ul>", "Only linked text here")])
def test_html_cases(page, text):
    assert html_text.main_text(page) == text


def test_html_on_pages(spark):
    import html as h

    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("n_chars", F.lit(0)).withColumn("text", F.lit("x"))
    for r in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        assert r["text"].split() == h.unescape(re.sub("<[^>]*>", " ", article)).split() and r["n_chars"] == len(r["text"])


def test_html_deep_and_empty(spark, nothing):
    assert html_text.main_text("<div>" * 20_000 + "x" + "</p>" * 20_000) == "x"
    assert html_text.extract(nothing, "text", "main").columns[-2:] == ["main", "n_chars"]


# --- decontamination

def edited(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        at, what = rnd.randrange(len(out)), rnd.randrange(3)
        if what == 0:
            out[at] = "zz"
        elif what == 1:
            out.insert(at, "yy")
        else:
            del out[at]
    return out


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(150)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randint(8, 60))] for _ in range(60)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))) for _ in range(60)]
    for i, item in enumerate(items):
        for k in (0, 1, decontaminate.max_edits(len(item)), decontaminate.max_edits(len(item)) + 2):
            texts.append(" ".join(["Pre,"] * 3 + edited(rnd, item, k) + ["post."] * 3).replace("w1", "W1"))
    texts += [None, "", "w1 " * 500]
    short = [(100 + k, " ".join(rnd.choice(vocabulary) for _ in range(k % 7 + 1))) for k in range(40)]
    short += [(150 + k, " ".join(texts[k].split()[5:5 + k % 7 + 1])) for k in range(60) if len(texts[k].split()) > 20]
    short += [(300, "w1 w1"), (301, "w1 w1 w1"), (302, "unseen words"), (303, "w2")]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (None, "x"), (91, "w1 w2"), (92, ""), *short], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.leaks(docs_of(spark, texts), bench, block_words=700).collect()}
    want = {}
    for d, t in enumerate(texts):
        w = np.array([int(x[1:]) if x[:1] == b"w" else -1 for x in decontaminate.item_words(t)], np.int64)
        for i, item in enumerate(items):
            e = decontaminate.edit_distance(np.array([int(x[1:]) for x in item]), w)
            if e <= decontaminate.max_edits(len(item)):
                want[d, i] = e
    verbatim = {(d, i): 0 for d, t in enumerate(texts) for i, x in [(91, "w1 w2"), *short]
                if f" {x.lower()} " in f" {b' '.join(decontaminate.item_words(t)).decode()} "}
    assert {x: e for x, e in got.items() if x[1] >= 90} == verbatim and len(verbatim) > 100
    got = {x: e for x, e in got.items() if x[1] < 90}
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want)
    assert all(got[x] == want[x] for x in got if want[x] == 0)


def test_leaks_edge_cases(spark, odd, nothing):
    bench = spark.createDataFrame([(1, PROSE), (1, PROSE)], "item_id long, text string")
    odd = odd.orderBy("doc_id")
    got = decontaminate.leaks(odd, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == [(6, 1, 0), (6, 1, 0), (7, 1, 0)]
    words = spark.createDataFrame([(1, PROSE.split()[0]), (2, " ".join(PROSE.split()[:4]))], "item_id long, text string")
    assert decontaminate.leaks(odd, words).filter("item_id = 1").count() >= 3 == decontaminate.leaks(odd, words).filter("item_id = 2").count()
    assert decontaminate.without_leaks(odd, words.filter("item_id = 1")).count() == 11 and decontaminate.without_leaks(odd, words).count() == 8
    left = decontaminate.without_leaks(odd, bench)
    assert left.columns == odd.columns and left.count() == 8
    assert decontaminate.leaks(nothing, bench).count() == 0 == decontaminate.leaks(odd, bench.limit(0)).count()
    assert decontaminate.without_leaks(odd, bench.limit(0)).count() == 11


# --- toxicity

def test_toxicity_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = toxicity.train(docs, labels.filter(~held))
    assert np.all(np.diff(model.thresholds) > 0)
    got = toxicity.score(docs.join(labels.filter(held), "doc_id").select("text", "toxic"), model).select("toxic", "severity").collect()
    hit = sum(r["severity"] >= toxicity.REJECT_AT for r in got if r["toxic"] == 1) / sum(r["toxic"] == 1 for r in got)
    false = sum(r["severity"] >= toxicity.REJECT_AT for r in got if r["toxic"] == 0) / sum(r["toxic"] == 0 for r in got)
    assert hit > 0.85 and false < 0.01, (hit, false)


def test_toxicity_grades_and_edge_cases(spark, odd, nothing):
    texts, y = ["bad bad", "bad xx xx", "bad xx xx xx", "bad", "xx", "yy", "xx yy", "zz"] + ["zz"] * 4, np.array([1] * 4 + [0] * 8)
    g = toxicity.grades(toxicity.matrix(texts), y)
    assert list(g[4:]) == [0] * 8 and set(g[:4]) == {1, 2} and g[2] == 1
    labels = spark.createDataFrame([(5, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)  # one class only
    got = toxicity.score(odd, model)
    assert got.columns == [*[c for c in odd.columns if c != "severity"], "severity"]
    assert [r["severity"] < 1e-9 for r in got.collect()] == [True] * 11
    assert toxicity.score(nothing, model).count() == 0


# --- mixing

def test_mix_targets_and_order(spark, odd, nothing):
    rnd = random.Random(6)
    texts = ["w " * rnd.randint(1, 300) for _ in range(900)]
    d = docs_of(spark, texts, ["a" if i % 3 == 0 else f"s{i % 7}" for i in range(900)])
    got = mixing.mix(d).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    for mine in by.values():
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1
        assert mine[0]["target"] <= 2 * mine[0]["source_size"] == 2 * sum(r["size"] for r in mine)
    assert abs(sum(m[0]["target"] for m in by.values()) - 1.5 * sum(r["size"] for r in got)) < 1e-6 * sum(r["size"] for r in got)
    places = [r["position"] for r in got if r["position"] is not None]
    assert places == sorted(places)
    assert {(r["doc_id"], r["taken"], r["position"]) for r in got} == {(r["doc_id"], r["taken"], r["position"]) for r in mixing.mix(d.repartition(7)).collect()}
    stream = mixing.training_stream(d, mixing.mix(d)).collect()
    assert sum(r["train_words"] for r in stream) == sum(r["taken"] for r in got)
    # heavy sources come earlier in training than light ones
    mean = {s: np.mean([r["train_position"] for r in stream if r["source"] == s]) for s in ("a", "s1")}
    assert mean["a"] < mean["s1"]


def test_mix_edge_cases(odd, nothing):
    got = mixing.mix(odd).collect()
    assert len(got) == 11 and mixing.mix(nothing).count() == 0
    assert all(r["taken"] == 0 and r["position"] is None for r in got if r["size"] == 0)
