"""A small forgiving DOM for pages: tags, attributes and text, with the end tags HTML lets authors leave out."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag.
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key ends open elements of the value, within the nearest of their containers.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"}}
#: What is nested deeper hangs on the element at this depth; no text is lost.
MAX_DEPTH = 150
CONTAINERS = frozenset("ul ol menu dl table select body article section div".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def parse(html: str) -> Node:
    """The tree below a root named `html`. Unknown, unclosed or stray tags never fail."""
    root = Node("#root")
    stack, at = [root], 0
    while at < len(html):
        token = _TOKEN.search(html, at)
        if token is None:
            _text(stack[-1], html[at:])
            break
        _text(stack[-1], html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            _end(stack, tag)
            continue
        _implied(stack, tag)
        attributes = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(token[3])} if token[3].strip() else {}
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            node.children.append(unescape(html[at : end.start() if end else len(html)]))
            at = end.end() if end else len(html)
        elif tag not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)
    return root


def _text(node: Node, raw: str) -> None:
    if raw:
        node.children.append(unescape(raw))


def _end(stack: list[Node], tag: str) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == tag:
            del stack[depth:]
            return
        if tag not in BLOCKS and stack[depth].tag in BLOCKS:
            return  # an inline end tag doesn't reach out of a block


def _implied(stack: list[Node], tag: str) -> None:
    """Close an open paragraph before a block, and items before the next item."""
    ends = CLOSES.get(tag, set())
    for depth in range(len(stack) - 1, 0, -1):
        open_tag = stack[depth].tag
        if open_tag in ends or (open_tag == "p" and tag in BLOCKS):
            del stack[depth:]
            return _implied(stack, tag)
        if open_tag in CONTAINERS:
            return None
    return None
