"""Main text of web pages by tag-path ratios.

Text nodes with the same path of tags from the root play the same part in a page.  For each
path the text and the punctuation of its nodes are added up and divided by their number;
in page order both series are smoothed and multiplied, and nodes above a share of the
series' deviation are content.  The article is the ``article`` or ``main`` element that holds
most of the content, or else the lowest element that holds all of it; no content is left out
of the latter, and short lines between long ones stay.

What an element says about itself comes first: scripts, forms, navigation, sidebars,
adverts, notices and comments are left out by tag or role before ratios are taken.  A class
or id leaves an element out only if it holds less than half of the page's text, or the page
has its article elsewhere, and never if it is or holds the article: many wrappers just
mention what is beside them.  All of it takes time in proportion to the page, however deep.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from statistics import pstdev

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.text import unused

# HTML's elements by how they nest and break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
SPACES = frozenset(("br", "wbr", "img"))
# Elements that end when another of theirs begins inside the same list or table.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog footer form iframe map math menu nav noscript object search select svg "
    "template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promoted promotion recommended related replies responses share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget".split()
)
ARTICLES = frozenset(("article", "main"))
PLAIN = frozenset("p li pre blockquote td th dd dt figcaption h1 h2 h3 h4 h5 h6".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that are parts of an article, never the article.
PARTS = PLAIN | frozenset("ul ol dl menu dir table tbody thead tfoot tr caption figure details summary fieldset legend".split())

# Share of the deviation above which a node is content, and the smoothing kernel.
LAMBDA = 0.5
KERNEL = (1.0, 2.0, 1.0)
# Share of the content by which an article is known, and of the page's text that a name can leave out.
MOST, SMALL = 0.5, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|xmp|noembed|noframes)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?¡¿…()\"'«»„“”‚‘’\u2013\u2014\u3001\u3002\uff0c\uff01\uff1f\uff1a\uff1b]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Element:
    """An element with its place in the tree; ``out``, ``linked`` and ``article`` hold for all that is inside it."""

    tag: str
    parent: Element | None
    path: int
    number: int
    last: int
    holder: str
    out: bool
    called: bool
    linked: bool
    article: Element | None


@dataclass(slots=True)
class Node:
    """A piece of text with its place in the page."""

    text: str
    block: int
    inside: Element


def _says(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is left out by what it is, and by what it is called."""
    out = tag in LEFT_OUT or (tag == "header" and not in_article)
    if tag in ("html", "body"):
        return False, False
    called = False
    if attrs.strip():
        for m in _ATTRIBUTE.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
                out = True
            elif name == "role":
                out |= value.lower() in ROLES
            elif name in ("class", "id"):
                words = {w.lower() for w in _NAME.findall(value)}
                called |= bool(words & NAMES) or ("header" in words and not in_article)
    return out, called


class Page:
    """The elements of a page in order, each before what is inside it, and its text nodes, those in left-out elements not."""

    def __init__(self, html: str):
        self.elements = [Element("", None, 0, 0, 0, "body", False, False, False, None)]
        self.found: list[Node] = []
        self._stack = [self.elements[0]]
        # Where in the stack each tag is open.
        self._open: dict[str, list[int]] = defaultdict(list)
        self._paths: dict[tuple[int, str], int] = {}
        self._block = 0
        at = 0
        for m in _TOKEN.finditer(html):
            self._text(html[at : m.start()])
            at = m.end()
            if m["tag"] is None:
                continue
            tag = m["tag"].lower()
            if m["end"]:
                self._block += tag in BLOCKS
                if self._open[tag]:
                    self._close(self._open[tag][-1])
            else:
                self._begin(tag, m["attrs"])
        self._text(html[at:])
        self._close(0)

    def _text(self, piece: str) -> None:
        if piece and not self._stack[-1].out:
            self.found.append(Node(unescape(piece), self._block, self._stack[-1]))

    def _close(self, index: int) -> None:
        while len(self._stack) > index:
            element = self._stack.pop()
            element.last = len(self.elements) - 1
            if self._stack:
                self._open[element.tag].pop()
            self._block += element.tag in BLOCKS

    def _close_first(self, ends: set[str], inside: set[str] | frozenset[str]) -> None:
        """Close the outermost of ``ends`` that is open inside the innermost of ``inside``."""
        if not any(self._open[t] for t in ends):
            return
        last = max((self._open[t][-1] for t in inside if self._open[t]), default=0)
        within = [self._open[t][bisect_right(self._open[t], last)] for t in ends if self._open[t] and self._open[t][-1] > last]
        if within:
            self._close(min(within))

    def _begin(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS:
            self._block += 1
            # A block ends an open paragraph, whatever stands inside it.
            self._close_first({"p"}, BLOCKS - {"p"})
        if tag in SIBLINGS:
            self._close_first(*SIBLINGS[tag])
        if tag in SPACES:
            self._text(" ")
        if tag in VOID or (attrs.endswith("/") and tag not in BLOCKS):
            return
        above = self._stack[-1]
        out, called = _says(tag, attrs, above.article is not None)
        path = self._paths.setdefault((above.path, tag), len(self._paths) + 1)
        element = Element(
            tag, above, path, len(self.elements), 0, tag if tag in BLOCKS else above.holder, above.out or out, called,
            above.linked or tag == "a", None,
        )
        element.article = element if tag in ARTICLES else above.article
        self.elements.append(element)
        self._open[tag].append(len(self._stack))
        self._stack.append(element)

    def named_out(self) -> list[bool]:
        """By element: whether its own name, or that of one around it, leaves it out."""
        size = [0] * len(self.elements)
        for n in self.found:
            if not n.inside.linked:
                size[n.inside.number] += len(n.text.strip())
        for e in reversed(self.elements[1:]):
            size[e.parent.number] += size[e.number]
        inside_named = [False] * len(self.elements)
        for e in self.elements[1:]:
            inside_named[e.number] = e.called or inside_named[e.parent.number]
        # The article that is not named away itself, and else the largest that is.
        articles = [e for e in self.elements if e.tag in ARTICLES and not e.out]
        article = max(articles, key=lambda e: (not inside_named[e.number], size[e.number], -e.number), default=None)
        around, e = set(), article
        while e:
            around.add(e.number)
            e = e.parent
        left = [False] * len(self.elements)
        for e in self.elements[1:]:
            own = e.called and e.number not in around
            if own and (article is None or article.number <= e.number <= article.last):
                own = size[e.number] <= SMALL * size[0]
            left[e.number] = left[e.parent.number] or own
        return left


def _smooth(series: list[float]) -> list[float]:
    reach = len(KERNEL) // 2
    out = []
    for i in range(len(series)):
        near = [(series[i + k - reach], w) for k, w in enumerate(KERNEL) if 0 <= i + k - reach < len(series)]
        out.append(sum(x * w for x, w in near) / sum(w for _, w in near))
    return out


def content_nodes(found: list[Node]) -> list[bool]:
    """Which nodes are content by the ratios of their paths."""
    size, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in found:
        size[n.inside.path] += 0 if n.inside.linked else len(n.text.strip())
        marks[n.inside.path] += 0 if n.inside.linked else len(_MARKS.findall(n.text))
        count[n.inside.path] += 1
    lengths = _smooth([size[n.inside.path] / count[n.inside.path] for n in found])
    points = _smooth([marks[n.inside.path] / count[n.inside.path] for n in found])
    fused = [a * (1 + b) for a, b in zip(lengths, points)]
    least = LAMBDA * pstdev(fused) if fused else 0.0
    return [x >= least and not n.inside.linked for x, n in zip(fused, found)]


def article_of(chosen: list[Node]) -> Element | None:
    """The element that is the article, by the content nodes."""
    held: dict[int, int] = defaultdict(int)
    for n in chosen:
        if n.inside.article:
            held[n.inside.article.number] += len(n.text)
    if not chosen:
        return None
    if sum(held.values()) >= MOST * sum(len(n.text) for n in chosen):
        chosen = [n for n in chosen if n.inside.article]
    first, last = min(n.inside.number for n in chosen), max(n.inside.number for n in chosen)
    element = next(n.inside for n in chosen if n.inside.number == first)
    # The lowest that holds them all; a part of an article stands for what it is part of.
    while element.parent and (element.last < last or element.tag in PARTS or element.tag not in BLOCKS):
        element = element.parent
    return element.article or element


def main_text(html: str | None) -> str:
    """The article's blocks, one per line; white space inside a block is one space."""
    page = Page(html or "")
    every = page.found
    found = [n for n in every if n.text.strip()]
    left = page.named_out()
    # Where names rule out everything, they were chosen for something else.
    found = [n for n in found if not left[n.inside.number]] or found
    picked = content_nodes(found)
    chosen = [n for n, yes in zip(found, picked) if yes]
    root = article_of(chosen)
    own = {n.block for n in chosen}
    # Without an element of its own, the article runs from the heading above its first content to its last.
    whole = root is not None and root.tag not in ("", "html", "body")
    ends = [i for i, yes in enumerate(picked) if yes] or [0]
    start = ends[0]
    while not whole and start and found[start - 1].inside.holder in HEADINGS:
        start -= 1
    kept = set()
    for i, n in enumerate(found):
        if root is None or root.number <= n.inside.number <= root.last:
            plain = n.inside.holder in PLAIN and not n.inside.linked and (whole or root is None or start <= i <= ends[-1])
            if n.inside.article or n.block in own or plain:
                kept.add(id(n))
    wanted = {n.block for n in found if id(n) in kept}
    lines: dict[int, list[str]] = defaultdict(list)
    for n in every:
        if id(n) in kept or (n.block in wanted and not n.text.strip()):
            lines[n.block].append(n.text)
    joined = (" ".join("".join(parts).split()) for parts in lines.values())
    return "\n".join(line for line in joined if line)


@F.pandas_udf(T.StringType())
def _main_texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(html) for html in batch], dtype="object")


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All rows and columns but the html, with text and n_chars (its code points).

    Null, empty and unreadable html give an empty text; html without tags is a text of one
    block.  Repeated rows come back as often.  Where ``pages`` has columns of these names
    the new ones get underscores.  An empty table gives an empty result.
    """
    rest = [c for c in pages.columns if c != html]
    text, n_chars = unused(pages.select(rest), "text"), unused(pages.select(rest), "n_chars")
    read = pages.select(*[F.col(f"`{c}`") for c in rest], _main_texts(F.col(f"`{html}`")).alias(text))
    return read.withColumn(n_chars, F.length(text).cast("long"))
