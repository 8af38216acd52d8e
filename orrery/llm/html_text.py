"""Main text of web pages by tree scoring.

The page is read into a tree of elements with its text in blocks. Every block of prose
passes points for its length and commas to its ancestors, all to the parent, half to the
grandparent, less and less above; an element's sum is discounted by its link density. The
best container is kept, widened to the article element around it, and with it the page's
other articles and those of its siblings that score well or are prose or headings, whatever
their length. Without an article element all its siblings are kept that aren't mostly links.
Where no text but links has any points, all of it is kept. Menus, page headers and footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments are left out
wherever they stand: by element; by class, id and role names that mean nothing else on any
element; by ambiguous ones ("header", "alert", "social") on containers alone, not on
paragraphs, headings, cells or inline elements. Inside an article an ambiguous name that is
only a part of one ("entry-header") leaves out a container only if it is mostly links.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import read_table

# element kinds by name
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes annotation annotation-xml".split())
_LEFT_OUT = frozenset("""head title script style noscript iframe textarea template svg object embed canvas audio video
    nav header footer aside menu form button select option dialog fieldset noembed noframes""".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr br nobr
    math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded mphantom
    mfenced menclose mmultiscripts mprescripts mtable mtr mtd annotation annotation-xml""".split())
_CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3
    h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul""".split())
# an opening tag ends an open element of these kinds, unless one of the others lies between
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
         "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
         "option": (("option",), ("select",)), "tbody": (("thead", "tbody", "tr"), ("table",)), "body": (("head",), ())}
_SCOPE = frozenset("table td th button object template html".split())
# class, id and role names of what isn't the article; the second group has other meanings too
_SIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|popup|newsletter|subscri\w*|paywall|sidebar\w*|"
    r"complementary|navbar|navigation|breadcrumbs?|masthead|contentinfo|comments?|commentlist|disqus|replies|respond|share|sharing|pagination|"
    r"outbrain|taboola)(?:$|[\s_-])", re.I)
_MAYBE = (r"notice|alert|modal|overlay|menu|nav|header|footer|reply|social|related|recommend\w*|widget\w*|toolbar|pager|search|login|signup|"
          r"register|skip|hidden|invisible")
_MAYBE_PART, _MAYBE_WHOLE = re.compile(rf"(?:^|[\s_-])(?:{_MAYBE})(?:$|[\s_-])", re.I), re.compile(rf"(?:^|\s)(?:{_MAYBE})(?:$|\s)", re.I)
# whole names by which an article element is a comment or an advert
_OTHER_ARTICLE = re.compile(r"(?:^|\s)(?:comments?|reply|ads?|advert\w*|sponsored|promo)(?:$|\s)", re.I)
# elements that hold text rather than a part of the page
_TEXT = _INLINE | frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption caption dt dd tr td th".split())
DEPTH = 512
_WHOLE = frozenset("html body main article".split())
_TOKEN = re.compile(r"""<(?:!--(?P<comment>)|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>"']|"[^"<]*"|'[^'<]*')*+[^>]*+)>|[!?/][^>]*>)""")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("name", "parent", "side", "block", "depth", "score", "chars", "linked", "blocks", "maybe", "inside")

    def __init__(self, name, parent, side, maybe=False):
        # as in browsers, what is nested deeper than DEPTH stands beside its parent
        while parent is not None and parent.depth >= DEPTH:
            parent = parent.parent
        self.name, self.parent, self.side = name, parent, side
        self.depth = parent.depth + 1 if parent is not None else 0
        self.block = self if parent is None or name not in _INLINE else parent.block
        self.maybe = maybe  # left out if it is mostly links
        self.inside = name == "article" or parent is not None and parent.inside  # of an article
        self.score, self.chars, self.linked, self.blocks = 0.0, 0, 0, 0

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0

    def is_menu(self) -> bool:
        """A list of short links (longer ones are references), or links under a name for such."""
        return self.maybe and self.density() >= 0.5 or self.name == "ul" and self.density() >= 0.8 and self.chars < 25 * self.blocks


def _kind(name: str, attrs: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is not the article's, and whether that is so only if it is mostly links."""
    if name in _LEFT_OUT:
        return True, False
    if not attrs.strip("/ "):
        return False, False
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    if "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "").lower():
        return True, False
    names = [got[k] for k in ("class", "id", "role") if k in got]
    if name in _WHOLE or not names:
        return name == "article" and any(map(_OTHER_ARTICLE.search, names)), False
    if any(map(_SIDE.search, names)):
        return True, False
    if name in _TEXT or not any(map(_MAYBE_PART.search, names)):
        return False, False
    whole = not inside or any(map(_MAYBE_WHOLE.search, names))
    return whole, not whole


def blocks_of(page: str) -> list[tuple[str, int, Node]]:
    """(text, its characters inside links, its block element) in page order; white space in
    the text is single spaces."""
    root = Node("html", None, False)
    stack, out, parts, links = [root], [], [], 0
    in_link, at, is_open = 0, 0, Counter()

    def end_block():
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, min(links, len(text)), stack[-1].block))
            parts.clear()
            links = 0

    def pop_to(k):
        nonlocal in_link
        if any(n.name not in _INLINE for n in stack[k:]):
            end_block()
        in_link -= sum(n.name == "a" for n in stack[k:])
        is_open.subtract(n.name for n in stack[k:])
        del stack[k:]

    def add(text):
        nonlocal links
        if text:
            parts.append(text)
            if in_link:
                links += len(text.strip())

    while True:
        m = _TOKEN.search(page, at)
        add(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m["comment"] is not None:
            close = page.find("-->", at)
            at = len(page) if close < 0 else close + 3
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1) if is_open[name] else ():
                if stack[k].name == name:
                    pop_to(k)
                    break
                if stack[k].name in _SCOPE and name not in _SCOPE:
                    break
            continue
        ends, stop = _ENDS.get(name, ((), ()))
        if name in _CLOSES_P:
            ends, stop = ("p",), _SCOPE
        for k in range(len(stack) - 1, 0, -1) if any(is_open[e] for e in ends) else ():
            if stack[k].name in stop:
                break
            if stack[k].name in ends:
                pop_to(k)
                if name not in ("tr", "tbody"):
                    break
        if name == "br":
            add(" ")
        if name == "html" or name in _VOID and name != "hr":
            continue
        if name not in _INLINE:
            end_block()
        if name == "hr":
            continue
        if name in _RAW:
            # up to its end tag this is not markup, and it is never part of the text
            close = re.compile(f"</{name}", re.I).search(page, at)
            at = len(page) if close is None else close.start()
            if close is not None:
                gt = page.find(">", at)
                at = len(page) if gt < 0 else gt + 1
            continue
        parent = stack[-1]
        side, maybe = _kind(name, m["attrs"], parent.inside)
        stack.append(Node(name, parent, parent.side or side, maybe))
        in_link += name == "a"
        is_open[name] += 1
    end_block()
    return out


def _score(blocks) -> dict[int, Node]:
    """Pass every block's points up; the nodes by identity."""
    seen = {}
    for text, linked, node in blocks:
        if node.side:
            continue
        points = (min(len(text) / 100, 3) + len(_COMMAS.findall(text)) + (len(text) >= 25)) * (1 - linked / len(text))
        # a paragraph's points go to what holds it; text right inside a container counts for that
        up = node.parent if node.parent is not None and node.name in ("p", "pre", "li", "dd", "dt", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6") else node
        for x in [node, *_above(node)]:
            x.chars, x.linked, x.blocks = x.chars + len(text), x.linked + linked, x.blocks + 1
            seen[id(x)] = x
        for level, x in enumerate([up, *_above(up)]):
            x.score += points / (1, 2, 6)[min(level, 2)] / max(1, level - 1)
    return seen


def _above(node: Node):
    while node.parent is not None:
        node = node.parent
        yield node


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by line feeds. Null or empty: empty."""
    blocks = blocks_of(page or "")
    nodes = _score(blocks)
    ranked = [n for n in nodes.values() if n.score > 0]
    if not ranked:  # links only
        return "\n".join(text for text, _, node in blocks if not node.side and not any(x.is_menu() for x in [node, *_above(node)]))
    final = {id(n): n.score * (1 - n.density()) for n in ranked}
    best = max(ranked, key=lambda n: final[id(n)])
    top = final[id(best)]
    best = next((x for x in [best, *_above(best)] if x.name == "article"), best)
    kept, beside = {id(best)}, None
    if best.name == "article":
        for n in ranked:
            if n.name == "article" and not n.side and n.density() < 0.5:
                kept.add(id(n))
        for n in nodes.values():
            if n.parent is best.parent and n is not best and not n.side:
                prose = n.name in ("p", "pre", "blockquote") and n.density() < 0.25
                title = re.fullmatch("h[1-6]", n.name) and n.linked == 0
                if prose or title or final.get(id(n), 0.0) >= max(3.0, 0.2 * top) and n.density() < 0.25:
                    kept.add(id(n))
    else:
        while best.parent is not None and best.parent.blocks == best.blocks:  # it only wraps the container
            best = best.parent
        beside = best.parent  # its own text stands between the siblings
        kept = {id(best), *(id(n) for n in nodes.values() if n.parent is beside and not n.side and n.density() < 0.5)}
    out = []
    for text, linked, node in blocks:
        if node.side or any(x.is_menu() for x in [node, *_above(node)]):
            continue
        if id(node) in kept or node is beside and linked < 0.5 * len(text) or any(id(x) in kept for x in _above(node)):
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """Replace ``html_column`` by the main text ``out`` and its code points ``n_chars``.

    Null or empty html: empty text, 0. All rows and the other columns are kept, but those
    called like the new ones.
    """
    other = [c for c in pages.columns if c.lower() not in (html_column.lower(), out.lower(), "n_chars")]
    d = pages.select(*other, html_column)
    schema = d.select(*other).schema.add(out, "string").add("n_chars", "long")

    def run(batches):
        for b in batches:
            got = [main_text(x.as_py()) for x in b.column(len(other))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())],
                                             names=[*other, out, "n_chars"])

    return d.mapInArrow(run, schema)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.col("n_chars"))
