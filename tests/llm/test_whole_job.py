"""Places where an operator once did less than its whole job."""

import html as h
import random
import re

import pytest

from orrery.llm import decontaminate, html_text, line_dedup
from test_operators import SF, docs_of, edited


# --- line dedup

def test_lines_that_frame_other_texts_are_cut_from_short_documents(spark):
    notice = "This notice stands on very many sites, and it is longer than what some pages have to say."
    long = [f"{notice}\n{' '.join(f'word{i}x{k}' for k in range(40))}" for i in range(8)]
    short = [f"{notice}\nown {i}" for i in range(8)]
    # eight edited copies of a page: every copy shares its lines, none is framed by them
    copies = [f"stamp {i}\nthe first line of a page that was copied\nand the second line of it" for i in range(8)]
    sites = [f"s{i % 8}" for i in range(24)]
    got = {r["doc_id"]: r for r in line_dedup.remove_spread_lines(docs_of(spark, long + short + copies, sites)).collect()}
    for i in range(8):
        assert (got[8 + i]["text"], got[8 + i]["n_spread"], got[8 + i]["n_removed"]) == (f"own {i}", 1, 1)
        assert got[i]["text"] == long[i].split("\n")[1]
        assert (got[16 + i]["text"], got[16 + i]["n_spread"], got[16 + i]["n_removed"]) == (copies[i], 2, 0)


# --- HTML

LONG = "<p>" + "A long paragraph of the article, with commas, " * 9 + "</p>"
SHORT = "Short closing paragraph of the text."


@pytest.mark.parametrize("beside, text", [
    (f"<div><p>{SHORT}</p></div>", SHORT), ("<p>The end.</p>", "The end."), ("<h4>Note</h4><section>It was so.</section>", "Note\nIt was so."),
    ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<table><tr><td>1<td>2</table>", "1\n2"), ("Closing words.", "Closing words."),
    ("<div class=share><p>Tell others about it.</p></div>", ""), ("<div><a href=a>Home</a> <a href=b>About</a></div>", "")])
def test_short_siblings_of_the_container(beside, text):
    want = h.unescape(re.sub("<[^>]*>", "", LONG)).strip()
    assert html_text.main_text(f"<body><div>{LONG}</div>{beside}</body>") == "\n".join(filter(None, [want, text]))
    assert html_text.main_text(f"<body><nav>Menu</nav><div><div>{LONG}</div></div>{beside}</body>") == "\n".join(filter(None, [want, text]))


def test_link_only_items_of_the_article():
    refs = ["Author, A. (2001): The first of the works cited", "Author, B. (2002): The second of the works cited"]
    items = "".join(f"<li><a href=x>{r}</a>" for r in refs)
    for kind in ("ul", "ol"):
        got = html_text.main_text(f"<article>{LONG}<{kind}>{items}</{kind}></article>").split("\n")
        assert got[1:] == refs
    mixed = f"<article>{LONG}<ul><li>an item without a link, and some more text in it<li><a href=x>linked</a></ul></article>"
    assert html_text.main_text(mixed).split("\n")[2:] == ["linked"]


def test_article_split_over_containers(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect():
        before, article, after = re.fullmatch("(.*)<article>(.*)</article>(.*)", r["html"], re.S).groups()
        split = "".join(f"<div>{x}</div>" for x in re.split("(?<=</p>)", article) if x.strip())
        assert html_text.main_text(before + split + after).split() == h.unescape(re.sub("<[^>]*>", " ", article)).split()


# --- decontamination

def test_long_items_among_short_ones_are_found():
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [[rnd.choice(vocabulary) for _ in range(400 if i == 240 else rnd.randint(15, 59))] for i in range(241)]
    texts = [" ".join(["pre"] * 9 + edited(rnd, items[240], decontaminate.max_edits(400)) + ["post"] * 9) for _ in range(12)]
    index = decontaminate.Index([(i, [w.encode() for w in x]) for i, x in enumerate(items)])
    assert {(d, i) for d, i, _ in index.search(texts)} == {(d, 240) for d in range(12)}


def test_sizes_that_walks_cannot_reach_are_compared_exactly(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_REPEATS", 1)
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randint(10, 40))] for _ in range(30)]
    texts = [" ".join(edited(rnd, x, decontaminate.max_edits(len(x)))) for x in items] + [None, "", "v1 v2 " * 50]
    words = [decontaminate.item_words(t) for t in texts]
    number = lambda ws: decontaminate.np.array([int(w[1:]) if w[:1] == b"v" else -1 for w in ws], int)
    want = {}
    for d, t in enumerate(words):
        for i, x in enumerate(items):
            e = decontaminate.edit_distance(number([w.encode() for w in x]), number(t))
            if e <= decontaminate.max_edits(len(x)):
                want[d, i] = e
    index = decontaminate.Index([(i, [w.encode() for w in x]) for i, x in enumerate(items)])
    assert index.exact == index.sizes
    assert {(d, i): e for d, i, e in index.search(texts)} == want
