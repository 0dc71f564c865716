"""Main text of pages by composite text density.

A node's density is its characters per tag, lowered the more of them are link text. The sum of
the densities of a node's children marks where text gathers; the subtree with the largest sum
gives the main text, joined by others outside it whose density is not below the smallest on the
path from it to the body.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import text_batches
from parcelflow.llm.html_dom import BLOCKS, Node, parse

#: Elements that are never part of an article.
DROPPED = frozenset(
    "head title script style noscript template iframe nav menu aside footer form button select textarea input dialog svg canvas "
    "object embed audio video search".split()
)
#: Words of class, id or role that name what stands beside an article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe signup sidebar side aside rail nav navigation navbar menu breadcrumb breadcrumbs pager pagination footer "
    "comment comments reply replies discussion disqus respond share sharing social related recommended recommendations widget "
    "skip complementary contentinfo".split()
)
#: Those of readers' comments, which may well be most of a page.
COMMENTS = frozenset("comment comments reply replies discussion disqus respond".split())
#: Share of the body's text from which a part is not beside the article, whatever it is called: by one of the words alone,
#: and by a name that only holds one (has-sidebar, content-with-ads).
MOST, HALF = 0.9, 0.5
#: Least base of the density's logarithm; without links it would be 1.
LEAST_BASE = 1.05
_PARTS = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


def _letters(node: Node) -> int:
    """Characters of the node's text, without what is never shown."""
    return sum(
        len(_SPACE.sub(" ", c).strip()) if isinstance(c, str) else 0 if c.tag in DROPPED else _letters(c) for c in node.children
    )


def _beside(node: Node, in_article: bool, body_letters: int) -> bool:
    """Whether a node stands beside the article: by its tag, or by its names if it doesn't hold the page's text."""
    if node.tag in DROPPED or "hidden" in node.attributes or node.attributes.get("aria-hidden") == "true":
        return True
    if node.tag in ("body", "html", "main"):
        return False
    if node.tag == "header" or node.attributes.get("role") == "banner":
        return not in_article
    names = " ".join(node.attributes.get(k, "") for k in ("class", "id", "role")).lower().split()
    if node.tag == "article":
        return any(w in ("comment", "comments", "ad", "ads") for n in names for w in _PARTS.split(n))
    parts = {w for n in names for w in _PARTS.split(n)}
    if not BESIDE.intersection(parts):
        return False
    if COMMENTS.intersection(names):
        return True
    share = _letters(node) / max(1, body_letters)
    return share < (MOST if BESIDE.intersection(names) else HALF)


class Measured:
    """A node without what stands beside the article, and its counts: characters, tags, and those in links."""

    def __init__(self, node: Node, parent: Measured | None, in_link: bool = False, in_article: bool = False, letters: int | None = None):
        self.node, self.parent = node, parent
        letters = _letters(node) if letters is None else letters
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.children: list[Measured | str] = []
        link = in_link or node.tag == "a"
        inside = in_article or node.tag in ("article", "main")
        for child in node.children:
            if isinstance(child, str):
                n = len(_SPACE.sub(" ", child).strip())
                self.chars += n
                self.link_chars += n * link
                self.children.append(child)
            elif not _beside(child, inside, letters):
                part = Measured(child, self, link, inside, letters)
                self.chars += part.chars
                self.link_chars += part.link_chars
                self.tags += part.tags + 1
                self.link_tags += part.link_tags + (link or child.tag == "a")
                self.children.append(part)
        self.density = self.sum = 0.0

    def parts(self) -> list[Measured]:
        return [c for c in self.children if isinstance(c, Measured)]

    def measure(self, body: Measured) -> None:
        """Density of this node and all below, and the sums over children."""
        for part in self.parts():
            part.measure(body)
        c, t = self.chars, max(1, self.tags)
        lc, lt = max(1, self.link_chars), max(1, self.link_tags)
        plain = max(1, c - self.link_chars)
        base = max(LEAST_BASE, math.log(c / plain * self.link_chars + body.link_chars / max(1, body.chars) * c + math.e))
        self.density = c / t * math.log(max(1.0, c / lc * t / lt), base) if c else 0.0
        self.sum = sum(p.density for p in self.parts())

    def walk(self) -> Iterator[Measured]:
        yield self
        for part in self.parts():
            yield from part.walk()


def _find(node: Node, tag: str) -> Node | None:
    for child in node.children:
        if isinstance(child, Node):
            if child.tag == tag:
                return child
            if found := _find(child, tag):
                return found
    return None


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line ends; empty for a page that is null, empty or has no article text."""
    if not html:
        return ""
    root = parse(html)
    body = Measured(_find(root, "body") or root, None)
    body.measure(body)
    if not body.chars:
        return ""
    best = max(body.walk(), key=lambda m: (m.sum, m.chars))
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    # A subtree of an article is not the whole article.
    best = next((m for m in reversed(path) if m.node.tag in ("article", "main")), best)
    if best.sum <= 0 or not best.chars:
        best = body
    threshold = min(m.density for m in path)
    blocks: list[str] = []
    _collect(body, best, set(map(id, path)), threshold, blocks)
    lines = (_SPACE.sub(" ", b).strip() for b in blocks)
    return "\n".join(line for line in lines if line)


def _collect(node: Measured, best: Measured, path: set[int], threshold: float, blocks: list[str]) -> None:
    """In page order: the best subtree, and blocks beside the path to it that are as dense as the path."""
    if node is best:
        _write(node, blocks)
        return
    for part in node.parts():
        if id(part) in path or part is best or any(p is best for p in part.walk()):
            _collect(part, best, path, threshold, blocks)
        elif part.density >= threshold and part.node.tag in BLOCKS and part.density > 0 and best.node.tag not in ("article", "main"):
            _write(part, blocks)


def _write(node: Measured, blocks: list[str]) -> None:
    """Text of a subtree; a block element starts and ends a block, a line break is white space."""
    block = node.node.tag in BLOCKS
    if block or not blocks:
        blocks.append("")
    for child in node.children:
        if isinstance(child, str):
            blocks[-1] += child
        elif child.node.tag == "br":
            blocks[-1] += " "
        else:
            _write(child, blocks)
    if block:
        blocks.append("")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages; n_chars counts code points.

    A null or empty page has the empty text. Repeated rows stay, null ids and urls too. An empty
    table gives none. Other columns are not read.
    """
    slim = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")
    )
    kind = slim.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_batches(batches, "html"):
            texts = [main_text((h or b"").decode("utf-8", "replace")) for h in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return slim.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
