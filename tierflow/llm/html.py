"""Operator 2: main text of web pages by tree scoring.

A page becomes a tree of elements.  Paragraphs pass points for their length and commas to
their ancestors, halved at each step; a container's points are discounted by the share of
its text that lies in links.  The best container is kept with all siblings that are neither
furniture nor mostly links, or the article element around it as a whole.  Pages are parsed
where they are scanned, one by one; there is no shuffle.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
DROPPED = RAW | frozenset(
    "head nav footer aside form button select option label fieldset menu dialog object".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"html", "body"}
#: Words of class, id and role that mark what is not the article.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "contentinfo complementary consent cookie cookies disqus footer masthead menu modal nav navbar "
    "navigation newsletter notice notices popup promo related respond search sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)
#: What "share" goes with if it is a tool (and not, say, a price).
SHARING = frozenset("bar box button buttons icons links tools widget".split())
ARTICLE = frozenset("article main".split())


class Node:
    __slots__ = ("tag", "parent", "items", "link", "points", "chars", "linked", "furniture")

    def __init__(self, tag: str, parent: Node | None, furniture: bool):
        self.tag, self.parent, self.furniture = tag, parent, furniture
        self.items: list[Node | str] = []
        self.points = 0.0
        self.chars = self.linked = 0


def _is_furniture(tag: str, attributes: str, parents: list[Node]) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header":  # a page header, not the head of an article
        return not any(p.tag in ARTICLE for p in parents)
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for _, value in _ATTRIBUTE.findall(attributes):
        for name in value.lower().strip("\"'").split():
            words = set(re.split(r"[^a-z]+", name))
            if not FURNITURE.isdisjoint(words):
                return True
            if name == "share" or "share" in words and not SHARING.isdisjoint(words):
                return True
    return False


def parse(page: str) -> Node:
    """Tree of the page's elements; unclosed and stray tags are tolerated."""
    root = Node("#root", None, False)
    open_nodes = [root]
    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            break
        if found.start() > at:
            open_nodes[-1].items.append(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            for depth in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[depth].tag == tag:
                    del open_nodes[depth:]
                    break
                if open_nodes[depth].tag in ("article", "body", "td", "table") and tag not in BLOCKS:
                    break
            continue
        if tag in CLOSES_P:
            for depth in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[depth].tag == "p":
                    del open_nodes[depth:]
                    break
                if open_nodes[depth].tag in BLOCKS:
                    break
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            stop = ("ul", "ol", "dl", "table", "select", "tr" if tag in ("td", "th") else "table")
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            for depth in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[depth].tag in same:
                    del open_nodes[depth:]
                    break
                if open_nodes[depth].tag in stop:
                    break
        node = Node(tag, open_nodes[-1], _is_furniture(tag, found[3], open_nodes))
        open_nodes[-1].items.append(node)
        if tag == "svg" and found[3].rstrip().endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not found[3].rstrip().endswith("/") or tag in BLOCKS and tag not in VOID:
            open_nodes.append(node)
    if at < len(page):
        open_nodes[-1].items.append(page[at:])
    return root


def _blocks(top: Node) -> list[tuple[Node, str, int]]:
    """(element, text, characters in links) of the blocks below ``top`` in page order."""
    out: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    owner, linked = top, 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append((owner, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    stack: list[tuple[Node, int, bool]] = [(top, 0, False)]
    while stack:
        node, i, in_link = stack.pop()
        if i == 0 and node.tag in BLOCKS:
            flush()
            owner = node
        while i < len(node.items):
            item = node.items[i]
            i += 1
            if isinstance(item, str):
                parts.append(item)
                linked += len(item) * in_link
            elif item.furniture:
                if item.tag in BLOCKS:
                    flush()
            elif item.tag in ("br", "hr"):
                parts.append(" ")
            else:
                stack.append((node, i, in_link))
                stack.append((item, 0, in_link or item.tag == "a"))
                break
        else:
            if node.tag in BLOCKS:
                flush()
                up = node.parent
                while up is not None and up.tag not in BLOCKS:
                    up = up.parent
                owner = up or top
    flush()
    return out


def main_text(page: str | None) -> str:
    """Text of the best container; empty if the page has no text outside its furniture."""
    root = parse(page or "")
    blocks = _blocks(root)
    if not blocks:
        return ""
    scored: list[Node] = []
    for owner, text, linked in blocks:
        node: Node | None = owner
        while node is not None:
            node.chars += len(text)
            node.linked += linked
            node = node.parent
        points = 1 + text.count(",") + min(len(text) / 100, 5) if len(text) >= 25 else 0.5
        points *= 1 - linked / len(text)
        node = owner if owner.tag in ("div", "body", "td", "section", "article", "main", "#root") else owner.parent
        share = 1.0
        while node is not None and share > 0.05:
            if node.tag in BLOCKS or node is root:
                node.points += points * share
                scored.append(node)
                share /= 2
            node = node.parent
    best = max(scored, key=lambda n: n.points * (1 - n.linked / max(n.chars, 1)))
    around = best
    while around.parent is not None and around.tag not in ARTICLE:
        around = around.parent
    if around.tag in ARTICLE:
        best = around
    if best.parent is None or best.tag in ("body", "html"):
        return " ".join(text for _, text, _ in _blocks(best))
    around = Node(best.parent.tag, best.parent.parent, False)
    around.items = _with_siblings(best)
    return " ".join(text for _, text, _ in _blocks(around))


def _with_siblings(best: Node) -> list[Node | str]:
    """The best container and all that stands beside it, from the first to the last element
    that reads like text; furniture and what is mostly links stays out."""

    def reads(n: Node | str) -> bool:
        return isinstance(n, str) or n is best or not n.furniture and 2 * n.linked < max(n.chars, 1)

    beside = best.parent.items
    told = [i for i, n in enumerate(beside) if reads(n) and not isinstance(n, str) and (n is best or n.chars)]
    return [n for n in beside[told[0] : told[-1] + 1] if reads(n)]


def main_text_column(page: Column) -> Column:
    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return extracted(F.coalesce(page, F.lit("")))


def extracted(pages: DataFrame, page: str = "html") -> DataFrame:
    """page_id, url, main text and its length in code points of every page.

    NULL and empty pages have an empty text; repeated rows and NULL ids are kept; other
    columns are not looked at; an empty table gives an empty result.
    """
    return pages.select("page_id", "url", main_text_column(F.col(page)).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


#: Holds for pages of one article element with the character references named here.
ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS t FROM pages
), b AS (
  SELECT page_id, url, regexp_replace(t, '<[^>]*>', ' ', 'g') AS t FROM a
), c AS (
  SELECT page_id, url, replace(replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
    '&#x27;', ''''), '&#39;', '''') AS t FROM b
), d AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM c
)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""
