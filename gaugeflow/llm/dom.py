"""Block elements of an HTML page as a tree, with the text that stands in each.

Inline elements are part of their block; scripts, styles and comments are dropped. An open
paragraph, list item or table part ends where the next one begins, and a stray end tag is
passed over. An attribute's quoted value goes on to its closing quote, whatever it holds.
"""

from __future__ import annotations

import re
from html import unescape

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|template|noscript|iframe|svg|select)\b[^>]*+>.*?(?:</(?P=raw)\b[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)>"
    r"|<[!?/][^>]*+>?",
    re.S | re.I,
)
LABELS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
LETTERS = re.compile(r"[a-z]+")

# Inline and empty elements, and elements that end an open one of the same group.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}


class Page:
    """Nodes in document order: tag, label words, parent, lengths of text and of link text;
    and the text runs (node, text) in document order."""

    def __init__(self, html: str):
        self.tags, self.labels, self.parents = ["#page"], [()], [-1]
        self.text, self.links = [0], [0]
        self.runs: list[tuple[int, str]] = []
        self.attributes: list[str] = [""]
        self._stack, self._part, self._link = [0], [], 0
        at = 0
        for token in TOKEN.finditer(html):
            self._add(html[at : token.start()])
            at = token.end()
            tag = token["tag"]
            if tag is not None:
                self._tag(tag.lower(), bool(token["end"]), token["attrs"])
        self._add(html[at:])
        self._flush()

    def _add(self, text: str) -> None:
        if not text:
            return
        if "&" in text:
            text = unescape(text)
        self._part.append(text)
        n = len(text) - text.count(" ")
        self.text[self._stack[-1]] += n
        if self._link:
            self.links[self._stack[-1]] += n

    def _flush(self) -> None:
        if self._part:
            text = " ".join("".join(self._part).split())
            if text:
                self.runs.append((self._stack[-1], text))
            self._part = []

    def _tag(self, tag: str, end: bool, attrs: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self._link = 0 if end else 1
            elif tag == "br":
                self._part.append(" ")
            return
        self._flush()
        stack, tags = self._stack, self.tags
        if end:
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] == tag:
                    del stack[depth:]
                    break
            return
        if tag != "html" and tag != "body" and tags[stack[-1]] == "p":
            stack.pop()
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                own = tags[stack[depth]]
                if own in within:
                    break
                if own in ends:
                    del stack[depth:]
                    break
        if tag in EMPTY:
            return
        words: list[str] = []
        if "=" in attrs:
            for found in LABELS.findall(attrs):
                words += LETTERS.findall("".join(found).lower())
        self.parents.append(stack[-1])
        stack.append(len(tags))
        tags.append(tag)
        self.labels.append(tuple(words))
        self.attributes.append(attrs)
        self.text.append(0)
        self.links.append(0)
