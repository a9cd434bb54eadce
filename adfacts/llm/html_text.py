"""Main text of web pages by composite text density.

The page becomes a tree of nodes. What is never article text (scripts, styles, forms, menus,
headers, footers, sidebars, notices, adverts, comments: by tag, role, class or id) is cut away
first. Class names that only speak of such a part (``has-sidebar``, ``no-sidebar``) do not count, nor do
header names inside an article; there a paragraph, list item or table cell counts only if a whole
class says so (``notice``, not ``notice-board``). A form or an element named so is none of these if
it holds the page's only ``article`` or ``main``, or, on a page without one, more than half of the text (comments
excepted), so that the wrapper ``layout sidebar-right`` keeps its article; a form that holds so much never
is. A form's controls are. For every other node, with its characters C, tags T, link characters LC and link tags LT:

    density = C/T * log(C/LC * T/LT) / log(ln(C/(C-LC) * LC + LC_body/C_body * C + e))

(zeros count as one). A node's density sum is the sum of its children's densities. The node with the largest sum is
found, and the smallest density on its path from the body is the threshold. That node, and within
every node beside the path that reaches the threshold the one with the largest sum, are the main
content. Subtrees are joined in page order, each block by block. Of subtrees inside an ``article``
or ``main`` that whole element is taken, and then none outside one.

White space inside a block becomes one blank, a line break included; character references are
decoded. Declarations in mark-up (``<![...``) end with their next ``>``, whatever they hold. Nothing
else is dropped or capped.

Defined results: null and empty pages, and pages without text, give the empty text. Text
outside any element counts as the body's. Unclosed tags end with their parent or the next block
of their kind. Repeated rows get equal results. Other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set(
    "script style noscript template head title svg math canvas iframe object form button select "
    "textarea input nav footer aside dialog menu".split()
)
HEAD_PARTS = set("base link meta noscript script style template title".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
# A start tag that ends an open element of one of these kinds.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|banner|sponsor\w*|promo\w*|sidebar|side|nav\w*|menu\w*|"
    r"breadcrumbs?|header|masthead|footer|cookie\w*|consent|notice|gdpr|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|comments?|disqus|replies|respond|related|recommend\w*|share|sharing|social|"
    r"widget|toolbar|pagination|pager|login|signup|skip)(?:$|[\s_-])",
    re.I,
)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies|respond)(?:$|[\s_-])", re.I)
# Elements of running text: inside an article only a whole class name makes them noise.
TEXT_PARTS = set("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption span em strong b i a".split())
HEADING = re.compile(r"(?:^|[_-])(?:header|masthead)(?:$|[_-])", re.I)
SPEAKS_OF = re.compile(r"(?:^|[_-])(?:has|have|no|not|with|without|hide)[_-]", re.I)
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "children", "parent", "depth", "noise", "doubtful", "comments", "chars", "tags",
                 "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: bool) -> None:
        self.tag, self.parent, self.noise = tag, parent, noise
        self.doubtful = self.comments = False
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []
        self.density = self.total = 0.0
        self.chars = self.tags = self.link_chars = self.link_tags = 0


def _is_noise(tag: str, attributes: dict[str, str | None], in_article: bool) -> bool:
    if tag in SILENT - {"form"} or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if (attributes.get("role") or "").lower() in ROLES:
        return True
    if tag == "header":  # an article's own heading is part of it
        return not in_article
    return False


def _is_doubtful(tag: str, attributes: dict[str, str | None], in_article: bool) -> bool:
    """Noise by name or as a form, unless it turns out to hold the content."""
    if tag in {"body", "html", "article", "main", "header"}:
        return False
    names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split()
    names = [n for n in names if not SPEAKS_OF.search(n)]
    if in_article and any(HEADING.search(n) for n in names):
        names = [n for n in names if not HEADING.search(n)]
    if in_article and tag in TEXT_PARTS:
        return any((found := NOISE.search(n)) and found.group() == n for n in names)
    return tag == "form" or any(NOISE.search(n) for n in names)


def _settle_doubtful(root: Node) -> None:
    """Clear ``noise`` of doubtful nodes that hold the content; see the module's text."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node) and (c.doubtful or not c.noise)]
    if not any(n.doubtful for n in order):
        return
    chars = {}
    holds, open_nodes = set(), {root}
    for node in order:
        if node is not root and node.parent in open_nodes and not node.noise:
            open_nodes.add(node)
    marked = any(n.tag in {"article", "main"} for n in open_nodes)
    for node in reversed(order):
        chars[node] = sum(
            len(SPACE.sub("", c)) if isinstance(c, str) else chars.get(c, 0) for c in node.children
        )
        if node.tag in {"article", "main"} or node in holds:
            holds.add(node)
            if node.parent is not None:
                holds.add(node.parent)
    for node in order:
        large = 2 * chars[node] > chars[root] and not node.comments
        large = large and (node.tag == "form" or not (marked or holds))
        if node.doubtful and (large or (not marked and node in holds)):
            node.noise = False


class TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("body", None, False)
        self.open: dict[str, list[Node]] = {}  # by tag, outermost first

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or (self.here.tag == "head" and tag not in HEAD_PARTS):
            self._end({"head"}, stop=set())  # its end tag may be left out
        if tag in {"html", "body"}:
            return
        if tag in BLOCKS:
            self._end({"p"}, stop=(BLOCKS | SILENT) - {"p"})
        if tag in ENDS:
            self._end(ENDS[tag], stop={"ul", "ol", "dl", "table", "select"})
        attributes = dict(attrs)
        in_article = bool(self.open.get("article") or self.open.get("main"))
        node = Node(tag, self.here, _is_noise(tag, attributes, in_article))
        if not node.noise and _is_doubtful(tag, attributes, in_article):
            node.noise = node.doubtful = True
            names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
            node.comments = bool(COMMENTS.search(names))
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node
            self.open.setdefault(tag, []).append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in {"html", "body"}:
            self._end({tag}, stop=set() if tag in BLOCKS or tag in SILENT else BLOCKS)

    def _end(self, tags: set[str], stop: set[str]) -> None:
        """Close the nearest open element of ``tags``, unless one of ``stop`` is in between."""
        node = self._nearest(tags)
        if node is None:
            return
        between = self._nearest(stop - tags)
        if between is not None and between.depth > node.depth:
            return
        while self.here is not node.parent:
            self.open[self.here.tag].pop()
            self.here = self.here.parent

    def _nearest(self, tags: set[str]) -> Node | None:
        found = [nodes[-1] for tag in tags if (nodes := self.open.get(tag))]
        return max(found, key=lambda node: node.depth, default=None)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![`` in a page is a comment up to the next ``>``."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_data(self, data: str) -> None:
        if self.here.tag == "head" and not data.isspace():
            self._end({"head"}, stop=set())
        self.here.children.append(data)


def _measured(root: Node) -> list[Node]:
    """Nodes that are not noise, parents first, with their counts and densities."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.noise]
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                n = len(SPACE.sub("", child))
                node.chars += n
                node.link_chars += n if node.tag == "a" else 0
            elif not child.noise:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_tags += child.link_tags + (child.tag == "a")
                node.link_chars += child.chars if node.tag == "a" else child.link_chars
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        node.density = _density(node, share)
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.noise)
    return order


def _density(node: Node, body_share: float) -> float:
    c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    if c == 0:
        return 0.0
    base = math.log(c / max(c - node.link_chars, 1) * lc + body_share * c + math.e)
    ratio = max(c / lc * t / lt, 1e-9)
    return c / t * math.log(ratio) / math.log(base) if base > 1 + 1e-12 else c / t * math.log(ratio)


def main_nodes(root: Node) -> list[Node]:
    """The main content: subtrees in page order, none inside another."""
    order = _measured(root)
    best = max(order, key=lambda n: n.total)
    if best.total <= 0:
        return [root]
    threshold, node = best.density, best
    while node is not None:
        threshold, node = min(threshold, node.density), node.parent
    # Within each node: the first descendant (or itself) of the largest sum, and its sum.
    inner: dict[Node, Node] = {}
    for node in reversed(order):
        inner[node] = max(
            [node, *(inner[c] for c in node.children if isinstance(c, Node) and not c.noise)],
            key=lambda n: n.total,
        )
    # The body and what holds the best node reach the threshold by definition and would only
    # find it again, so what lies beside the path to it counts for itself.
    path, node = set(), best.parent
    while node is not None:
        path.add(node)
        node = node.parent
    found = {inner[n] for n in order if n not in path and n.density >= threshold and n.density > 0}
    found.add(best)
    chosen, covered = [], set()
    for node in order:
        if node.parent in covered:
            covered.add(node)
        elif node in found:
            covered.add(node)
            chosen.append(node)
    return chosen


def _blocks(node: Node) -> list[str]:
    blocks, words = [], []

    def close() -> None:
        text = SPACE.sub(" ", "".join(words)).strip()
        if text:
            blocks.append(text)
        words.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            words.append(item)
        elif item.tag == "br":
            words.append(" ")
        elif item is node or not item.noise:
            inner: list[Node | str | None] = list(item.children)
            if item.tag in BLOCKS:
                inner = [None, *inner, None]
            todo += reversed(inner)
    close()
    return blocks


def main_text(page: str | None) -> str:
    """The article of a page, one block per line; empty if there is none."""
    builder = TreeBuilder()
    builder.feed(page or "")
    builder.close()
    _settle_doubtful(builder.root)
    nodes = main_nodes(builder.root)
    # Density finds the body of an article; its heading and thin blocks belong to it too. If the
    # page marks its article, what lies outside is none of it.
    marked = [_around(n) for n in nodes]
    if any(marked):
        nodes = [n for n in dict.fromkeys(marked) if n]
    return "\n".join(block for n in nodes for block in _blocks(n))


def _around(node: Node | None) -> Node | None:
    """The nearest article or main that holds the node."""
    while node is not None and node.tag not in {"article", "main"}:
        node = node.parent
    return node


def main_text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in parts:
            yield pd.Series([main_text(p if isinstance(p, str) else None) for p in pages], dtype=object)

    return batch(html)
