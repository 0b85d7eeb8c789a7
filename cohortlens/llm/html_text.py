"""Main text of web pages by composite text density.

A page is read into a tree of elements (unclosed ones end as HTML ends them) and what is never
main text is left out: menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts and styles, by element, role and words of class and id. Every element left gets the
density of Sun, Song and Liao (2011), characters per tag lowered by the share of links; an
element's density sum is that of its children. The container with the largest sum leads to the main
text, whatever it is called; names only tell how far that reaches. In an article or main element, it
reaches to all of it, and other articles are main text too. Elsewhere every part joins it that is at
least as dense as the thinnest element on the path from it to the body. A heading right before it
that outranks its own belongs to it.

All of the chosen parts is kept: character references are decoded, white space in a block becomes
one space, blocks are trimmed and joined by line feeds in page order; a line break element counts
as white space. Pages are read whole, in Arrow batches, and never shuffled.

Nulls and edges: null or empty html, or html without main text, gives the empty text; null and
repeated ids and urls are carried; other columns are ignored; pages may be of any length and depth
and be malformed in any way: the time grows with the length alone, as no search is repeated that has
failed before and open elements are known by name.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common

# Elements without content, with raw text, that end a paragraph, and that are blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp".split())
#: The end tag of an element of raw text, whatever stands before it.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE | re.ASCII) for tag in RAW}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: An element closes an open one of these when it begins, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold blocks; the main text is looked for among them.
CONTAINERS = frozenset("body div article section main td center".split())
# Elements, roles and words of a class or id that mark what is not main text.
ASIDE_TAGS = frozenset("nav header footer aside form menu button select dialog label head".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies disqus footer form header login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification pagination popup promo promoted "
    "promotion related replies reply share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split()
)

#: A class with one of these says what a page has, as in "page-with-sidebar", or is a phrase.
LAYOUT_WORDS = frozenset("with without has no layout from about for by of on in to the and".split())
#: With one of these a header is that of the text.
TEXT_WORDS = frozenset("article post entry story".split())

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
#: What ends a tag, or begins a quoted value in it.
IN_TAG = re.compile(r">|=\s*[\"']")
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"[a-z]+")
PART_BYTES = 4_000_000


class Element:
    __slots__ = (
        "tag", "parent", "inside", "aside", "article", "scope", "chars", "tags", "link_chars", "link_tags", "density", "total",
    )

    def __init__(self, tag: str, parent: Element | None, aside: bool) -> None:
        self.tag, self.parent, self.aside = tag, parent, aside
        self.inside: list[Element | str] = []
        #: The outermost article, else main, element around it.
        self.article: Element | None = parent.article if parent else None
        if tag == "article" and (self.article is None or self.article.tag == "main") or tag == "main" and self.article is None:
            self.article = self
        #: Open elements that a new one may close, by name.
        self.scope: dict[str, Element] = parent.scope if parent else {}
        if tag in _ENDED or tag in _STOPS:
            gone = _STOPS.get(tag, ())
            self.scope = {k: v for k, v in self.scope.items() if k not in gone}
            if tag in _ENDED:
                self.scope[tag] = self


_PARAGRAPH = ({"p"}, {"td", "th", "li"})
_RULES = [*CLOSES.values(), _PARAGRAPH]
_ENDED = set().union(*(closed for closed, _ in _RULES))
#: Of an element, the names that what is in it cannot end.
_STOPS = {stop: set().union(*(c for c, stops in _RULES if stop in stops)) for _, all_stops in _RULES for stop in all_stops}


def _closed_by(tag: str) -> set[str]:
    """Names of the open elements that end where this one begins; one of them is open at most."""
    return CLOSES[tag][0] if tag in CLOSES else _PARAGRAPH[0] if tag in BLOCKS else set()


def _marked(token: str, block: bool) -> bool:
    """Whether a class or id says that an element is beside the main text.

    A container is by any listed word in it, a block of text by listed words alone.
    """
    words = WORD.findall(token)
    listed = ASIDE_WORDS.intersection(words)
    if not listed or not LAYOUT_WORDS.isdisjoint(words):
        return False
    if listed == {"header"} and not TEXT_WORDS.isdisjoint(words):
        return False
    return not block or len(listed) == len(set(words))


def _is_aside(tag: str, attributes: str) -> bool:
    if tag in ASIDE_TAGS:
        return True
    if not attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in ASIDE_ROLES:
            return True
        if name in ("class", "id") and any(_marked(t, tag in BLOCKS and tag not in CONTAINERS) for t in value.split()):
            return True
    return False


class _Tags:
    """Tags of a page, one after the other; (start, end, is an end tag, name, attributes)."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.last_quote = {q: page.rfind(q) for q in "\"'"}
        #: Places from which no tag ends, as a quoted value reaches to the end of the page.
        self.endless: set[int] = set()

    def _end(self, at: int) -> int:
        """The place of the `>` that ends a tag, outside quoted values if that can be."""
        page, here, passed = self.page, at, []
        while here not in self.endless and (match := IN_TAG.search(page, here)):
            if match[0] == ">":
                return match.start()
            passed.append(here)
            quote = page[match.end() - 1]
            if match.end() > self.last_quote[quote]:
                break
            here = page.find(quote, match.end()) + 1
        self.endless.update(passed)
        return page.find(">", at)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, False, "", ""
            if start > self.last:
                return None
            match = TAG.match(page, start)
            if match:
                end = self._end(match.end())
                return start, end + 1, match[1] == "/", match[2].lower(), page[match.end() : end]
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                return start, page.find(">", start) + 1, False, "", ""
            at = start + 1
        return None


def parse(page: str) -> Element:
    """The tree of a page; elements of raw text are left out."""
    root = Element("body", None, False)
    here, at = root, 0
    tags, open_ones = _Tags(page), Counter()

    def leave(node: Element) -> Element:
        """End an open element and all in it."""
        now = here
        while now is not node:
            open_ones[now.tag] -= 1
            now = now.parent
        open_ones[node.tag] -= 1
        return node.parent

    while found := tags.next(at):
        start, end, ends, tag, attributes = found
        if start > at:
            here.inside.append(page[at:start])
        at = end
        if not tag or tag in ("html", "body"):
            continue
        if ends:
            if open_ones[tag] > 0:
                node = here
                while node.tag != tag:
                    node = node.parent
                here = leave(node)
            continue
        if tag in RAW:  # raw text lasts until its own end, and what looks like tags in it is none
            if tag not in ("svg", "math") or not SELF_CLOSED.search(attributes):
                stop = RAW_END[tag].search(page, at)
                at = stop.end() if stop else len(page)
            continue
        for name in _closed_by(tag):
            if name in here.scope:
                here = leave(here.scope[name])
        if tag == "head":  # its end may be missing; its elements hold no text
            continue
        child = Element(tag, here, tag not in VOID and _is_aside(tag, attributes))
        here.inside.append(child)
        if tag not in VOID and not SELF_CLOSED.search(attributes):
            here = child
            open_ones[tag] += 1
    if at < len(page):
        rest = page[at:]
        here.inside.append(rest[: rest.rfind("<")] if re.search(r"<[A-Za-z/!][^<>]*\Z", rest) else rest)
    return root


def _ordered(root: Element) -> list[Element]:
    """Elements, each before what is in it."""
    out = [root]
    for node in out:
        out.extend(x for x in node.inside if isinstance(x, Element))
    return out


def _measure(root: Element) -> list[Element]:
    """Leave out what is not main text and set the densities of the rest; returns what is left."""
    nodes = _ordered(root)
    gone = _gone(nodes)
    # An article is kept where its surroundings only look like something else by their class.
    articles = [n for n in nodes if n.tag in ("article", "main") and not n.aside]
    if articles and all(id(n) in gone for n in articles):
        _rescue(articles[0])
        gone = _gone(nodes)
    # So is the header of a text, one with a heading, in an article or beside paragraphs.
    beside = {id(n.parent) for n in nodes if n.tag == "p" and id(n) not in gone}
    headers = [
        n.parent
        for n in nodes
        if n.tag in HEADINGS and n.parent.tag == "header" and id(n.parent.parent) not in gone
        and (n.article is not None or n.parent.parent.parent is not None and id(n.parent.parent) in beside)
    ]
    for header in headers:
        _rescue(header)
    if headers:
        gone = _gone(nodes)
    left = [n for n in nodes if id(n) not in gone]
    for node in left:
        node.inside = [x for x in node.inside if isinstance(x, str) or id(x) not in gone]
    for node in reversed(left):
        link = node.tag == "a"
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for x in node.inside:
            if isinstance(x, str):
                node.chars += len(x.strip())
            else:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
        if link:
            node.link_chars = node.chars
    for node in left:
        node.density = density(node.chars, node.link_chars, node.tags, node.link_tags, root.chars, root.link_chars)
    for node in left:
        node.total = sum(x.density for x in node.inside if not isinstance(x, str))
    return left


def density(chars: int, link_chars: int, tags: int, link_tags: int, all_chars: int, all_link_chars: int) -> float:
    """Composite text density of an element: characters per tag, times a logarithm that falls as
    more of them stand in links, compared with the whole body."""
    links, tags, link_tags = max(1, link_chars), max(1, tags), max(1, link_tags)
    other = max(1, chars - link_chars)
    base = math.log(chars / other * links + all_link_chars / max(1, all_chars) * chars + math.e)
    ratio = chars / links * tags / link_tags
    return chars / tags * math.log(ratio) / math.log(base) if chars and ratio > 1 and base > 1 else 0.0


def _gone(nodes: list[Element]) -> set[int]:
    """What is left out, with all that is in it; parents stand before children."""
    gone = set()
    for node in nodes:
        if node.aside or node.parent is not None and id(node.parent) in gone:
            gone.add(id(node))
    return gone


def _rescue(node: Element | None) -> None:
    while node is not None:
        node.aside = False
        node = node.parent


def _before(parent: Element) -> dict[int, tuple[list[Element], bool]]:
    """Of each element in a parent the headings right before it, nearest first, and whether nothing
    else stands before them."""
    told, heads, only = {}, [], True
    for x in parent.inside:
        if isinstance(x, str):
            if x.strip():
                heads, only = [], False
            continue
        told[id(x)] = (heads, only)
        heads, only = ([x, *heads], only) if x.tag in HEADINGS else ([], False)
    return told


def _headings_before(part: Element, told: dict[int, dict]) -> set[int]:
    """Headings right before an element, or before what it begins, that outrank its own."""
    rank = min((int(n.tag[1]) for n in _ordered(part) if n.tag in HEADINGS), default=7)
    found, node, only = set(), part, True
    while only and node.parent is not None:
        parent = node.parent
        if id(parent) not in told:
            told[id(parent)] = _before(parent)
        heads, only = told[id(parent)][id(node)]
        for head in heads:
            if int(head.tag[1]) >= rank:
                return found
            found.add(id(head))
            rank = int(head.tag[1])
        node = parent
    return found


def _chosen(root: Element) -> list[Element]:
    """The parts of a page that make up its main text, in page order."""
    left = _measure(root)
    if not root.chars:
        return []
    # Where sums are equal, the longer text, an article or main, and the first.
    places = [n for n in left if n.tag in CONTAINERS]
    best = max(places, key=lambda n: (n.total, n.chars, n.tag in ("article", "main")))
    top = best.article or best
    parts = [top]
    if best.article:
        # Other articles with text of their own are main text as well.
        parts += [n for n in left if n.tag == "article" and n.article is n and n.chars > n.link_chars and n is not top]
    wanted = set(map(id, parts))
    above = set()  # what leads to a part
    for node in left:
        if id(node) in wanted:
            while (node := node.parent) is not None and id(node) not in above:
                above.add(id(node))
    if not best.article:
        threshold = min(n.density for n in left if n is top or id(n) in above)
        wanted |= {id(n) for n in left if id(n) not in above and n.chars and n.density >= threshold}
    told: dict[int, dict] = {}
    wanted = wanted.union(*(_headings_before(part, told) for part in parts))
    chosen, open_nodes = [], [root]
    while open_nodes:  # depth first, in page order
        node = open_nodes.pop()
        if id(node) in wanted:
            chosen.append(node)
        elif id(node) in above:
            open_nodes.extend(x for x in reversed(node.inside) if isinstance(x, Element))
    return chosen


def _blocks(top: Element) -> list[str]:
    """Text of an element's blocks, in page order."""
    blocks, now = [], []

    def flush() -> None:
        text = " ".join(html.unescape("".join(now)).split())
        if text:
            blocks.append(text)
        now.clear()

    open_items: list = [top]
    while open_items:
        item = open_items.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            now.append(item)
        elif item.tag in ("br", "wbr", "img"):
            now.append(" " if item.tag == "br" else "")
        elif item.tag in BLOCKS or item is top:
            flush()
            open_items.append(None)
            open_items.extend(reversed(item.inside))
        else:
            open_items.extend(reversed(item.inside))
    flush()
    return blocks


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(block for part in _chosen(parse(page)) for block in _blocks(part))


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """Columns `keep` of each row, the main text and its code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in common.texts_in_parts(iter([batch]), [], "#html", PART_BYTES):
                found = [main_text(x.decode()) for x in texts]
                rows = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(i) for i in range(len(keep))],
                        pa.array(found, pa.string()),
                        pa.array([len(x) for x in found], pa.int64()),
                    ],
                    [*keep, "#text", "#n_chars"],
                )

    schema = pages.select(*keep).schema.add("#text", "string").add("#n_chars", "long")
    out = pages.select(*keep, F.col(html_col).alias("#html")).mapInArrow(run, schema)
    return out.select(*keep, F.col("#text").alias("text"), F.col("#n_chars").alias("n_chars"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(common.read(spark, sf_dir, "pages"), ["page_id", "url"])
