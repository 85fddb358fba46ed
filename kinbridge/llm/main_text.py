"""Main text of web pages by composite text density.

A page becomes a tree of its tags.  Parts that say what they are (navigation, footers,
forms, scripts, or names such as ``cookie-notice``) leave it first.  Every remaining node
has the characters and tags below it, and how many of them lie in links; its density is
characters per tag, adjusted so that links lower it.  The densities of a node's children
add up; the node of the greatest sum holds the article.  The least density on its path to
the body is the page's threshold: from the body downwards, of every node that reaches it,
the subtree of the greatest sum is text.  Where the page marks the article itself, the
subtree is that article.

Text of one block is one line: character references are decoded, white space (that of
``str.split``) becomes one blank, and blocks are joined by line ends in page order.  Line
breaks and inline tags do not end a block.

Null and empty pages, and pages without text outside the removed parts, have empty text.
Tags may be open, crossed or unknown; beyond a depth of ``DEEPEST`` they lie side by side.  Repeated rows and null ids are rows as all others.
One page must fit a task.  Extra columns are carried by ``with_text`` and not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tag names by what they mean for text.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby "
    "rb rp rt s samp small span strike strong sub sup time tt u var wbr "
    # Parts that leave no trace in the line they stand in.
    "audio button canvas embed iframe img input label map meta link noscript object script "
    "select style svg template textarea video".split()
)
#: Tags that may stand in a page's head.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Never part of the text, whatever they hold.
REMOVED = frozenset(
    "script style noscript template iframe object embed svg canvas audio video nav footer aside "
    "form button select option textarea input label dialog menu title head".split()
)
REMOVED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar".split()
)
#: Words in class and id names of parts that are not the article.
REMOVED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot "
    "sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent "
    "gdpr notice notices notification notifications popup modal overlay newsletter subscribe "
    "subscription signup login sidebar sidebars aside widget widgets nav navbar navigation menu "
    "menus breadcrumb breadcrumbs masthead header footer comment comments commentlist disqus "
    "respond reply replies share sharing social related recommended recommendations pagination "
    "pager toolbar search form".split()
)
#: Beginnings of names that speak of the layout around, not of the part itself.
LAYOUT = frozenset("has with no without is not".split())
ARTICLES = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open tag of the first kind is closed by the tags that follow it.
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option", "optgroup"]),
}
CLOSING = frozenset().union(*CLOSED_BY.values())
#: Tags nested deeper are put beside each other, as browsers do.
DEEPEST = 500
#: Tags whose inside is a page of its own to the rules above.
FENCES = {
    "li": frozenset(["ul", "ol", "menu"]),
    "dt": frozenset(["dl"]),
    "dd": frozenset(["dl"]),
    "tr": frozenset(["table"]),
    "td": frozenset(["table"]),
    "th": frozenset(["table"]),
    "option": frozenset(["select"]),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*>",  # a quote is left open
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Node:
    __slots__ = (
        "tag", "parent", "depth", "children", "removed", "named", "chars", "tags", "link_chars",
        "link_tags", "density", "sum", "best", "chosen",
    )

    def __init__(self, tag: str, parent: Node | None, removed: bool = False, named: bool = False):
        self.tag, self.parent, self.children = tag, parent, []
        self.depth = 0 if parent is None else parent.depth + 1
        self.removed, self.named = removed, named
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        #: The node of the greatest sum in this subtree, the first of equal ones.
        self.best = self
        self.chosen = False

    def up(self) -> Iterator[Node]:
        node = self
        while node is not None:
            yield node
            node = node.parent


def _speaks_of_removal(names: str) -> bool:
    """Whether a class or id names a part that is not the article."""
    for name in names.split():
        parts = [p.lower() for p in _NAME_PART.findall(name)]
        if parts and parts[0] not in LAYOUT and not REMOVED_NAMES.isdisjoint(parts):
            return True
    return False


def _kind(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether a tag is removed for what it is, and for how it is named."""
    if tag in REMOVED:
        return True, False
    if tag in ("html", "body", "main") or "=" not in attributes:
        return False, False
    named = removed = False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "role":
            removed = removed or value.strip().lower() in REMOVED_ROLES
        elif key in ("class", "id"):
            named = named or _speaks_of_removal(unescape(value))
    return removed, named


def parse(page: str) -> tuple[Node, list[tuple[Node, str | None]]]:
    """The tree of a page and its text in order; None marks the end of a block."""
    root = Node("html", None)
    now = root
    parts: list[tuple[Node, str | None]] = []
    at, end = 0, len(page)
    last = page.rfind(">")
    while at < end:
        token = _TOKEN.search(page, at) if at <= last else None
        if token is None and (comment := page.find("<!--", at)) >= 0:
            end = comment  # never closed
        begin = token.start() if token else end
        if begin > at:
            parts.append((now, page[at:begin]))
        if not token:
            break
        at = token.end()
        tag = token.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            parts.append((now, None))
        if tag == "br":
            parts.append((now, " "))
        if token.group(1):
            # What follows the end of the body still belongs to it.
            now = now if tag in ("body", "html") else _closed(now, tag)
            continue
        attributes = token.group(3)
        if tag in ("html", "body") and any(n.tag == tag for n in now.up()):
            continue
        now = _place(now, tag)
        removed, named = _kind(tag, attributes)
        node = Node(tag, now, removed, named)
        now.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            if tag not in REMOVED:
                parts.append((node, page[at : close.start() if close else end]))
            at = close.end() if close else end
        elif tag not in VOID and node.depth < DEEPEST and not (attributes.endswith("/") and tag in REMOVED):
            now = node
    return root, parts


def _place(now: Node, tag: str) -> Node:
    """Closes what a new tag closes without saying so; returns its parent."""
    if tag not in INLINE:
        # A paragraph ends at the next block, with all that is open in it.
        for node in now.up():
            if node.tag == "p":
                now = node.parent
                break
            if node.tag not in INLINE:
                break
    if now.tag == "head" and tag not in IN_HEAD:
        return now.parent
    for node in now.up() if tag in CLOSING else ():
        closers = CLOSED_BY.get(node.tag)
        if closers is not None and tag in closers:
            now = node.parent
            if tag in CLOSED_BY.get(now.tag, ()):
                return now.parent
            return now
        if node.tag in FENCES.get(tag, ()) or (node.tag in ARTICLES or node.tag == "body"):
            break
    return now


def _closed(now: Node, tag: str) -> Node:
    for node in now.up():
        if node.tag == tag:
            return now if node.parent is None else node.parent
        if tag in INLINE and node.tag not in INLINE:
            break
    return now


def _in_order(root: Node) -> list[Node]:
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        found.append(node)
        waiting.extend(reversed(node.children))
    return found


def _remove(nodes: list[Node]) -> None:
    """Settles which nodes are removed; what lies in a removed one is removed, too."""
    holds_article, holds_heading = set(), set()
    for node in nodes:
        if node.tag in ARTICLES or node.tag == "h1":
            holds_article.update(map(id, node.up()))
        if node.tag in HEADINGS:
            holds_heading.update(map(id, node.up()))
    for node in nodes:
        if node.parent is not None and node.parent.removed:
            node.removed = True
        elif node.tag == "header":
            # The heading of an article is part of it.
            inside = any(up.tag in ARTICLES for up in node.up())
            node.removed = node.removed or not (inside and id(node) in holds_heading)
        elif node.named and (node.tag == "article" or id(node) not in holds_article):
            node.removed = True


def _weigh(nodes: list[Node], parts: list[tuple[Node, str | None]]) -> None:
    """Counts of characters and tags, all and in links, and densities."""
    for node, text in parts:
        if text is not None and not node.removed:
            node.chars += len("".join(text.split()))
    kept = [n for n in nodes if not n.removed]
    for node in reversed(kept):
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = next((n for n in kept if n.tag == "body"), nodes[0])
    links_of_body = body.link_chars / max(1, body.chars)
    for node in kept:
        if not node.chars:
            continue
        links = max(1, node.link_chars)
        others = max(1, node.chars - node.link_chars)
        base = log(node.chars / others * links + links_of_body * node.chars + e)
        per_tag = node.chars / max(1, node.tags)
        adjusted = log(node.chars / links * max(1, node.tags) / max(1, node.link_tags)) / base
        node.density = per_tag * max(0.0, adjusted)
        if node.parent is not None:
            node.parent.sum += node.density
    for node in reversed(kept):
        for child in node.children:
            if not child.removed and child.best.sum > node.best.sum:
                node.best = child.best


def _marked_article(body: Node, nodes: list[Node]) -> Node | None:
    """The article as the page marks it: around the richest node, or most of its text."""
    best = body.best
    for tag in ARTICLES:
        around = [n for n in best.up() if n.tag == tag]
        if around:
            return around[-1]
        inside = [
            n for n in nodes
            if n.tag == tag and not n.removed and n.chars * 3 >= max(1, best.chars)
            and any(up is best for up in n.up())
        ]
        if inside:
            return max(inside, key=lambda n: n.chars)
    return None


def _choose(root: Node, nodes: list[Node]) -> None:
    body = next((n for n in nodes if n.tag == "body"), root)
    article = _marked_article(body, nodes)
    if article is not None:
        article.chosen = True
        return
    threshold = min(n.density for n in _up_to(body.best, body))
    waiting = [body]
    while waiting:
        node = waiting.pop()
        if not node.removed and node.chars and node.density >= threshold:
            node.best.chosen = True
            waiting.extend(node.children)


def _up_to(node: Node, top: Node) -> Iterator[Node]:
    for up in node.up():
        yield up
        if up is top:
            return


def main_text(page: str | None) -> str:
    """The article of a page, one line per block."""
    if not page:
        return ""
    root, parts = parse(page)
    nodes = _in_order(root)
    _remove(nodes)
    _weigh(nodes, parts)
    _choose(root, nodes)
    for node in nodes:
        if node.removed:
            node.chosen = False
        elif node.parent is not None and node.parent.chosen:
            node.chosen = True
    blocks, block = [], []
    for node, text in [*parts, (root, None)]:
        if text is None:
            line = " ".join(unescape("".join(block)).split())
            if line:
                blocks.append(line)
            block = []
        elif node.chosen:
            block.append(text)
    return "\n".join(blocks)


def with_text(pages: DataFrame, name: str = "text") -> DataFrame:
    """Adds the main text of column ``html``."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None).astype(object)

    return pages.withColumn(name, extract(F.col("html")))
