"""Card segmentation: the one place that walks HTML elements.

Nested elements cannot be cut out of a page with patterns, so a small reader
turns a page into raw card texts. It works on Arrow batches; all field parsing
that follows is Catalyst expressions.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections import defaultdict
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Executors get these helpers with the task, the package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "source", "track", "wbr",
}
BLOCK = {
    "address", "article", "aside", "br", "dd", "div", "dl", "dt", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "section",
    "table", "td", "tr", "ul",
}
# What most of a page is made of: text up to a tag, and a tag of plain names and double-quoted values without
# references, which every reader takes alike. A script or style comes with its whole text.
PLAIN = re.compile(
    r"""([^<]*)<(?:/([a-zA-Z][a-zA-Z0-9]*)>|!--[^<>-]*-->"""
    r"""|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9-]*="[^"&]*")*)[ \t\n]*>)"""
)
PLAIN_ATTRIBUTE = re.compile(r'([a-zA-Z][a-zA-Z0-9-]*)="([^"]*)"')
CODE_END = re.compile(r"(?:[^<]|<(?![/!]))*</(script|style)>")
DOCTYPE = re.compile(r"<!doctype html>", re.I)
CARD_FIELDS = ["title", "price", "place", "address"]
CARD_TEXTS = ("text", "lines")
CARD_TYPE = (
    "array<struct<selector:int,text:string,lines:string,href:string,own_href:string,"
    + ",".join(f"{f}:string" for f in CARD_FIELDS)
    + ">>"
)


class Element:
    __slots__ = ("tag", "attrs", "first_piece", "last_piece", "index", "last_index")

    def __init__(self, tag, attrs, piece, index):
        self.tag, self.attrs, self.index = tag, attrs, index
        self.first_piece = piece
        self.last_piece = self.last_index = None


class PageReader(HTMLParser):
    """Elements in page order; ``pieces`` holds texts, with None at block borders.

    Plain markup is read by one pattern a tag; other start tags, and all that follows
    any other construct, by the standard reader, whose results are the same.
    """

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.elements, self.pieces, self.open = [], [], []
        self.open_tags = defaultdict(int)
        rest = self._read_plain(html)
        self.rawdata = ""
        self.feed(html[rest:])
        self.close()
        while self.open:
            self._shut()

    def _read_plain(self, html):
        """Read tags from the start; returns where the standard reader has to go on."""
        self.rawdata = html  # for the standard reader's own parse of a start tag
        start = DOCTYPE.match(html)
        at = start.end() if start else 0
        while True:
            found = PLAIN.match(html, at)
            if found:
                data, closed, opened, attrs = found.groups()
                after = found.end()
            else:
                mark = html.find("<", at)
                if not html[mark + 1 : mark + 2].isascii() or not html[mark + 1 : mark + 2].isalpha() or mark < 0:
                    return at
                data, closed, opened, attrs = html[at:mark], None, None, None
            if opened and opened.lower() in self.CDATA_CONTENT_ELEMENTS:
                code = CODE_END.match(html, after)
                if not code or code[1] != opened.lower():
                    return at
                after = code.end()
            if data:
                self.handle_data(unescape(data) if "&" in data else data)
            if not found:
                after = self.parse_starttag(mark)
                if after < 0:
                    return mark
                if self.cdata_elem:
                    return after
            elif closed:
                self.handle_endtag(closed.lower())
            elif opened:
                tag = opened.lower()
                self.handle_starttag(tag, [(n.lower(), v) for n, v in PLAIN_ATTRIBUTE.findall(attrs)] if attrs else ())
                if tag in self.CDATA_CONTENT_ELEMENTS:
                    self.handle_endtag(tag)
            at = after

    def _shut(self):
        done = self.open.pop()
        self.open_tags[done.tag] -= 1
        if done.tag in BLOCK:
            self.pieces.append(None)
        done.last_piece, done.last_index = len(self.pieces), len(self.elements)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.pieces.append(None)
        element = Element(tag, dict(attrs), len(self.pieces), len(self.elements))
        self.elements.append(element)
        self.open.append(element)
        self.open_tags[tag] += 1
        if tag in VOID:
            self._shut()

    def handle_endtag(self, tag):
        if self.open and self.open[-1].tag == tag:
            self._shut()
        elif self.open_tags[tag]:
            while self.open[-1].tag != tag:
                self._shut()
            self._shut()

    def handle_data(self, data):
        if not (self.open and self.open[-1].tag in ("script", "style")):
            self.pieces.append(data)

    def inside(self, element):
        """Elements within an element, in page order."""
        return self.elements[element.index + 1 : element.last_index]

    def text(self, element, joiner=" "):
        parts = self.pieces[element.first_piece : element.last_piece]
        return joiner.join(p.strip() for p in parts if p and p.strip())

    def lines(self, element):
        rows = [[]]
        for piece in self.pieces[element.first_piece : element.last_piece]:
            if piece is None:
                rows.append([])
            elif piece.strip():
                rows[-1].append(piece.strip())
        return "\n".join(" ".join(row) for row in rows if row)


def matches(element, selector):
    tag, attr, test, value = selector
    if tag and element.tag != tag:
        return False
    if not attr:
        return True
    if attr not in element.attrs:
        return False
    got = element.attrs[attr] or ""
    if test == "contains":
        return value in got
    if test == "has_word":
        return value in got.split()
    return test == "has" or got == value


def select_cards(page, selectors):
    """Elements matching the first selector that matches any, with its position."""
    for position, selector in enumerate(selectors):
        hits = [e for e in page.elements if matches(e, selector)]
        if hits:
            return position, hits
    return None, []


def part_text(page, inside, selectors):
    """Text of the first of a card's elements for the first selector that matches any."""
    for selector in selectors:
        for element in inside:
            if matches(element, selector):
                return page.text(element, "")
    return None


def read_cards(html, selectors, fields, limit, texts=CARD_TEXTS):
    """Raw texts of the cards of one page; of ``CARD_TEXTS`` those named in ``texts``."""
    if not html:
        return []
    page = PageReader(html)
    position, cards = select_cards(page, selectors)
    rows = []
    for card in cards[:limit]:
        inside = page.inside(card)
        links = (e.attrs["href"] for e in inside if e.tag == "a" and "href" in e.attrs)
        rows.append(
            {
                "selector": position,
                "text": page.text(card) if "text" in texts else None,
                "lines": page.lines(card) if "lines" in texts else None,
                "href": next(links, None),
                "own_href": card.attrs.get("href"),
                **{name: part_text(page, inside, fields[name]) for name in fields},
            }
        )
    return rows


def read_place(html):
    """First label mentioning a district, and the last breadcrumb entry."""
    if not html:
        return None
    page = PageReader(html)
    named = [i for i, piece in enumerate(page.pieces) if piece and "bairro" in piece.lower()]

    def mentions(element):
        at = bisect_left(named, element.first_piece)
        return at < len(named) and named[at] < element.last_piece

    labels = (e for e in page.elements if e.tag in ("p", "span", "div") and mentions(e))
    label = next(labels, None)
    crumb, trail_end = None, 0
    for element in page.elements:
        if element.tag == "a" and element.index < trail_end:
            crumb = element
        if "breadcrumb" in (element.attrs.get("class") or "").split():
            trail_end = max(trail_end, element.last_index)
    marked = [e for e in page.elements if e.tag == "a" and e.attrs.get("rel") == "breadcrumb"]
    crumb = marked[-1] if marked else crumb
    return {
        "label": page.text(label) if label else None,
        "crumb": page.text(crumb, "") if crumb else None,
    }


def cards_of(
    html: Column, selectors: list, fields: dict, limit: int | None, texts: tuple = CARD_TEXTS
) -> Column:
    """Raw cards of a page as an array, at most ``limit`` (None: all); texts that are not asked for are null."""
    wanted = [tuple(s) for s in selectors]
    parts = {name: [tuple(s) for s in options] for name, options in fields.items()}

    @F.arrow_udf(CARD_TYPE)
    def cards(pages: pa.Array) -> pa.Array:
        strings = [(f, pa.string()) for f in ["text", "lines", "href", "own_href", *CARD_FIELDS]]
        kind = pa.list_(pa.struct([("selector", pa.int32()), *strings]))
        return pa.array(
            [read_cards(p.as_py(), wanted, parts, limit, texts) for p in pages], type=kind
        )

    return cards(html)


def page_places(html: Column) -> Column:
    """Address label and last breadcrumb of a page; null pages cost nothing."""

    @F.arrow_udf("struct<label:string,crumb:string>")
    def places(pages: pa.Array) -> pa.Array:
        kind = pa.struct([("label", pa.string()), ("crumb", pa.string())])
        return pa.array([read_place(p.as_py()) for p in pages], type=kind)

    return places(html)
