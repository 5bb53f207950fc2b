"""Main text of web pages by composite text density.

Each page is read into a DOM (lenient about unclosed tags).  Every node gets a
composite density: its characters per tag, adjusted by how much of them is
link text.  A node's density sum adds up its children's densities; the node
with the largest sum holds the article.  The smallest density on the path from
it to the body is the threshold: outside the article's container only blocks
at least that dense stay, inside it everything that is article text stays.
Elements that are never article text (menus, footers, asides, forms, scripts,
adverts, notices, comments) are cut by tag, role or class name beforehand.

One page is one row: no shuffle.  A null or empty page, or one without text,
gives an empty text; repeated rows are extracted one by one; of equally dense
elements the first in page order is taken; pages of any length are read whole; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame

from .common import table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|math|iframe|object|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary
    table tbody td tfoot th thead tr ul""".split())
#: an opening tag that ends an open element: by tag, what it ends and what bounds the search
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
ENDS_P = BLOCK - {"li", "dd", "dt", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "legend", "summary"}

#: never article text: by tag, by role, by a word of a class or id
CUT_TAGS = frozenset("""head nav footer aside form button select input label fieldset dialog menu audio video canvas
    applet embed map""".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
CUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
    navigation menu breadcrumb breadcrumbs sidebar footer header masthead comment comments discussion disqus replies cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social
    related recommended recommendations widget widgets pagination pager toolbar skip""".split())
MAIN = frozenset(("article", "main"))
#: elements that may be the article's container
CONTAINER = frozenset("article main section div td body table html center blockquote".split())
#: elements inside an article that a class name alone does not cut
KEEP = frozenset("article main body html h1 h2 h3 h4 h5 h6 p".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "main", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False):
        self.tag, self.parent, self.cut = tag, parent, cut
        self.parts: list = []  # texts and nodes, in page order
        self.main = tag in MAIN
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def _cut_by_name(tag: str, attributes: str) -> bool:
    if tag in CUT_TAGS:
        return True
    if tag in KEEP or not attributes.strip():
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in CUT_ROLES:
            return True
        if name in ("class", "id"):
            for one in value.split():
                words = re.split(r"[-_]+", one)
                if words[0] not in ("with", "has", "no", "main") and (words[0] in CUT_WORDS or words[-1] in CUT_WORDS):
                    return True
    return False


def parse(html: str) -> Node:
    """The DOM of a page; a stray end tag is skipped, an unclosed element ends with what holds it."""
    root = Node("html", None)
    at, last, open_tags = root, 0, {"html": 1}

    def close(node: Node, upto: Node) -> Node:
        while node is not upto:
            open_tags[node.tag] -= 1
            node = node.parent
        return node

    for m in TOKEN.finditer(html):
        if m.start() > last:
            at.parts.append(html[last:m.start()])
        last = m.end()
        tag = m.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(2):
            if tag in ("html", "body") or not open_tags.get(tag):
                continue
            node = at
            while node.tag != tag:
                node = node.parent
            at = close(at, node.parent)
            continue
        if tag == "html":
            continue
        if tag in ENDS_P and open_tags.get("p"):
            node = at
            while node.tag not in ("p", "td", "th", "button", "table", "html"):
                node = node.parent
            if node.tag == "p":
                at = close(at, node.parent)
        if tag in ENDS:
            ends, bounds = ENDS[tag]
            node, found = at, None
            while node.parent is not None and node.tag not in bounds:
                if node.tag in ends:
                    found = node
                node = node.parent
            if found is not None:
                at = close(at, found.parent)
        if tag == "body" and open_tags.get("head"):
            node = at
            while node.tag != "head":
                node = node.parent
            at = close(at, node.parent)
        attributes = m.group(4) or ""
        node = Node(tag, at, _cut_by_name(tag, attributes))
        at.parts.append(node)
        if tag in MAIN or 'role="main"' in attributes:
            up = node
            while up is not None and not (up.main and up is not node):
                up.main = True
                up = up.parent
        if tag not in VOID and not attributes.endswith("/"):
            open_tags[tag] = open_tags.get(tag, 0) + 1
            at = node
    if last < len(html):
        at.parts.append(html[last:])
    return root


def _is_cut(node: Node, in_main: bool) -> bool:
    if node.main:  # it holds the article, whatever its name says
        return False
    return node.cut or node.tag == "header" and not in_main


def weigh(root: Node) -> list[Node]:
    """Counts and composite densities of all nodes that may be article text, in page order."""
    order: list[Node] = []
    todo = [(root, False)]
    while todo:
        node, in_main = todo.pop()
        order.append(node)
        in_main = in_main or node.tag in MAIN
        node.parts = [x for x in node.parts if isinstance(x, str) or not _is_cut(x, in_main)]
        todo += [(x, in_main) for x in reversed(node.parts) if not isinstance(x, str)]
    for node in reversed(order):
        for x in node.parts:
            if isinstance(x, str):
                node.chars += sum(map(len, x.split()))
            else:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    ratio = root.link_chars / root.chars if root.chars else 0.0
    for node in order:
        c, t, lc, lt = node.chars, node.tags or 1, node.link_chars, node.link_tags
        if c:
            base = math.log(c * lc / ((c - lc) or 1) + ratio * c + math.e)
            node.density = c / t * math.log(c / (lc or 1) * t / (lt or 1) + 1) / math.log(base + 1)
    return order


def main_text(html: str | None) -> str:
    """Article text of one page, its blocks joined by new lines."""
    if not html:
        return ""
    root = parse(html)
    order = weigh(root)
    if not root.chars:
        return ""
    best, most = root, -1.0
    for node in order:
        total = sum(x.density for x in node.parts if not isinstance(x, str))
        total += sum(sum(map(len, x.split())) for x in node.parts if isinstance(x, str)) if node.tag not in ("html", "body") else 0
        if total > most and node.chars:
            best, most = node, total
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    threshold = min(x.density for x in path)
    holder = next((x for x in path if x.tag in MAIN), None) or next(x for x in path if x.tag in CONTAINER)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            text = " ".join(unescape("".join(line)).split())
            if text:
                blocks.append(text)
            line.clear()

    above = {id(x) for x in path[path.index(holder) + 1:]}
    todo: list = [(root, False)]
    while todo:
        x, inside = todo.pop()
        if isinstance(x, str):
            line.append(x)
            continue
        if x is None:
            flush()
            continue
        inside = inside or x is holder
        if not inside and id(x) not in above and x.density < threshold:
            continue
        if x.tag in BLOCK:
            flush()
            todo.append((None, False))
        elif x.tag in ("br", "wbr", "img"):
            line.append(" " if x.tag != "wbr" else "")
        inner = inside or id(x) not in above
        todo += [(y, inner) for y in reversed(x.parts) if inner or not isinstance(y, str)]
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at:at + 500]
                text = [main_text(x) for x in part["html"].tolist()]
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": text,
                                    "n_chars": [len(x) for x in text]})

    rows = pages.select(*[pages[c].alias(c) for c in ("page_id", "url", "html")])
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op9_html_text(spark, sf_dir):
    """Registered query: ``extract`` over all pages."""
    return extract(table(spark, sf_dir, "pages"))
