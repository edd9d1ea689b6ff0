"""HTML extraction by two-pass block rules.

A page is read once into blocks: runs of text between block-level tags, with
character references decoded and white space folded. Scripts, styles, markup and
elements that by tag or role hold menus, headers, footers, sidebars, notices,
adverts, forms or reader comments are cut while reading, and leave only a decided
"not text" mark in the sequence. Words of classes and ids are evidence only: an
element with such a word is cut, once the page is read, if the word is the main part
of a class or id or if none of its blocks is text by the first pass; but not if it
holds an article, a main part or most of the page's text (reader comments in an
article may be longer than it). The first pass decides a block by its

* link density: at least ``LINKED`` of its characters in anchors is not text;
* length and stop-word density: at least ``LONG`` words with at least
  ``STOP_DENSITY`` stop words among them is text.

The rest is ambiguous, and the second pass gives it the label of the nearest
decided block on either side in the same region (article, else main part, else
page); the nearer one wins, text wins a tie, and a region without any decided
block is text. If a page has articles with text, only they count; else its main
part; else the whole page. Where nothing at all is text, the ambiguous blocks are.

Null, empty and blank pages, and pages without text, give ''. Unclosed and
misnested tags, unclosed comments and scripts are read as far as they go; reading
is linear in the page. Rows are handled one by one, repeated rows alike, other
columns pass through.
"""

from __future__ import annotations

import html
import re
import sys
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINKED = 0.5
LONG = 10
STOP_DENSITY = 0.15

# Common function words of the languages read.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can for from had has have he her his if in into is it its
    more no not of on one or our out she so some such than that the their them then there these they this to up was we
    were what when which who will with would you your
    als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer eines er es für hat
    ich ihr im ist ja kann mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war wenn werden
    wie wir zu zum zur
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur lui mais ne nous on ou où par
    pas plus pour qu que qui sa se ses son sont sur un une vous y
    al como con cuando del el ella era esta este fue ha hay las lo los más me mi muy ni nos o para pero por porque sin
    sobre su sus también te tiene una uno ya
    """.split()
)

BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section select summary table tbody td tfoot th thead title tr ul
    """.split()
)
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe math noembed noframes noscript object script style svg template textarea title xmp".split())
CUT = frozenset("applet aside audio button canvas datalist dialog footer form head label map menu nav picture search select video".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tooltip".split()
)
# Words that classes and ids of such parts are made of.
HINTS = frozenset(
    """
    ad ads adsense advert advertisement adverts alert announcement banner breadcrumb breadcrumbs byline captcha comment
    commentary commentlist comments consent cookie cookies copyright disclaimer discussion disqus dropdown feedback
    flash foot footer gdpr head header login masthead menu menus message modal nav navbar navigation newsletter notice
    notices notification outbrain overlay pager pagination popup privacy promo promoted promotion recommended register
    related replies reply respond sharing share shoutbox sidebar sidebars signup skip social sponsor sponsored subscribe
    subscription taboola tags toolbar tooltip warning widget widgets
    """.split()
)
COMMENTS = frozenset("comment commentlist comments disqus replies reply respond shoutbox".split())
# Parts after which the main part of a class or id is sought, and parts that say what is about it.
TAILS = frozenset("area bar block body box container content group inner item items list outer row section text unit wrap wrapper".split())
ABOUT = frozenset("has have hide hides is no non not show shows with without".split())
CLOSES_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)"
    r"|<(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[A-Za-z][^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?+")
_WORD = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


def is_main(token: str) -> bool:
    """Whether the main part of a class or id, the last that is not a mere tail, is a hint."""
    parts = [w.lower() for w in _PARTS.findall(token)]
    if not parts or ABOUT.intersection(parts):
        return False
    while len(parts) > 1 and parts[-1] in TAILS:
        parts.pop()
    return parts[-1] in HINTS


def is_cut(name: str, attrs: str, inside: bool) -> tuple[bool, Hint | None]:
    """Whether an element is not part of the text, else the hint that it may not be; ``inside`` an article its header is."""
    if name in CUT or name == "header" and not inside:
        return True, None
    if not attrs or attrs.isspace():
        return False, None
    hint = None
    for match in _ATTR.finditer(attrs):
        key = match[1].lower()
        value = html.unescape(match[2] or match[3] or match[4] or "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True, None
        if key == "role" and value.lower() in ROLES or key == "style" and _HIDDEN.search(value):
            return True, None
        if key in ("class", "id"):
            words = {w.lower() for w in _PARTS.findall(value)}
            if name in ("html", "body", "main", "article"):
                words &= {"comment", "comments", "reply", "ad", "advert", "advertisement", "sponsored", "promo"} if name == "article" else set()
            if inside and name in ("header", "h1", "h2", "h3", "h4", "h5", "h6"):
                words -= {"head", "header"}
            if words & HINTS:
                if name == "article":
                    return True, None
                hint = hint or Hint()
                tokens = [t for t in value.split() if is_main(t)]
                if any(words & {w.lower() for w in _PARTS.findall(t)} for t in tokens):
                    hint.main = True
                    hint.comments |= inside and any(COMMENTS & {w.lower() for w in _PARTS.findall(t)} for t in tokens)
    return False, hint


@dataclass
class Hint:
    """An element that by a class or id may not be text: its blocks and what it holds."""

    main: bool = False
    comments: bool = False
    begin: int = 0
    end: int = 0
    held: int = 0
    holds: bool = False
    region: tuple[int, int] = (0, 0)


@dataclass
class Block:
    """A run of text, or with ``cut`` the mark of something left out."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    region: int = 0
    level: int = 0
    cut: bool = False
    text: str = ""
    label: bool | None = None
    glued: bool = False  # to the block before, in one run of text
    judged: bool = False


class Reader:
    """One pass over a page's tags and text."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, int, Hint | None]] = []
        self.open: dict[str, int] = {}
        self.cuts = 0
        self.links = 0
        self.regions: list[tuple[int, int]] = [(0, 0)]  # number and level: 2 article, 1 main part, 0 page
        self.made = 0
        self.held = 0
        self.hints: list[Hint] = []
        self.blocks: list[Block] = []
        self.now = Block()

    def flush(self, glued: bool = False) -> None:
        # A blank run counts where it is between others of one run of text.
        if self.now.parts:
            self.now.text = " ".join("".join(self.now.parts).split())
            if self.now.text or self.now.glued:
                self.blocks.append(self.now)
        number, level = self.regions[-1]
        self.now = Block(region=number, level=level, glued=glued and (self.now.glued or bool(self.now.text)))

    def mark(self) -> None:
        self.flush()
        number, level = self.regions[-1]
        self.blocks.append(Block(region=number, level=level, cut=True, label=False))

    def push(self, name: str, attrs: str) -> None:
        if name in BLOCKS:
            while self.stack and self.stack[-1][0] in ("p", *CLOSES_ITSELF.get(name, ())):
                self.pop()
            self.flush()
        cut, hint = is_cut(name, attrs, self.regions[-1][1] == 2)
        if cut and not self.cuts:
            self.mark()
        # A word that is only part of a class says nothing within a run of text.
        if self.cuts or hint is not None and not hint.main and name not in BLOCKS:
            hint = None
        if hint is not None:
            self.flush(glued=name not in BLOCKS)
            hint.begin, hint.held, hint.region = len(self.blocks), self.held, self.regions[-1]
            self.hints.append(hint)
        self.held += name in ("article", "main") and not cut and not self.cuts
        level = {"article": 2, "main": 1}.get(name, 0)
        if level >= self.regions[-1][1] and level and not cut and not self.cuts:
            self.made += 1
            self.regions.append((self.made, level))
            self.flush()
        else:
            level = 0
        self.cuts += cut
        self.links += name == "a"
        self.stack.append((name, cut, level, hint))
        self.open[name] = self.open.get(name, 0) + 1

    def pop(self) -> None:
        name, cut, level, hint = self.stack.pop()
        self.open[name] -= 1
        if name in BLOCKS or level or hint is not None:
            self.flush(glued=name not in BLOCKS)
        if hint is not None:
            hint.end, hint.holds = len(self.blocks), self.held > hint.held
        if level:
            self.regions.pop()
            self.flush()
        self.cuts -= cut
        self.links -= name == "a"

    def close(self, name: str) -> None:
        if not self.open.get(name):
            if name in BLOCKS:
                self.flush()
            return
        while self.stack[-1][0] != name:
            self.pop()
        self.pop()

    def words(self, text: str) -> None:
        if self.cuts:
            return
        text = html.unescape(text) if "&" in text else text
        self.now.parts.append(text)
        if self.links:
            self.now.linked += len("".join(text.split()))

    def read(self, page: str) -> list[Block]:
        at = 0
        while True:
            match = _TOKEN.search(page, at)
            if match is None:
                self.words(page[at:])
                break
            if match.start() > at:
                self.words(page[at : match.start()])
            at = match.end()
            name = (match["name"] or "").lower()
            if not name:
                continue
            if match["end"]:
                self.close(name)
            elif name in VOID:
                if name == "br":
                    self.words(" ")
                elif name == "hr":
                    self.flush()
            elif name in RAW:
                if name == "title":
                    self.flush()
                if not match["attrs"].endswith("/") or name not in ("svg", "math"):
                    end = _RAW_END[name].search(page, at)
                    at = end.end() if end else len(page)
            else:
                if name == "a" and self.open.get("a"):
                    self.close("a")
                self.push(name, match["attrs"])
        while self.stack:
            self.pop()
        self.flush()
        return settled(self.blocks, self.hints)


def settled(blocks: list[Block], hints: list[Hint]) -> list[Block]:
    """The blocks with a mark in place of every hinted element that is cut, and glued ones joined."""
    if not hints:
        return blocks
    letters, texts = [0], [0]  # up to each block: those not in links, and blocks the first pass takes
    for block in blocks:
        if not block.cut:
            block.label, block.judged = first_label(block), True
        letters.append(letters[-1] + len(block.text) - block.text.count(" ") - block.linked)
        texts.append(texts[-1] + bool(block.label))
    out: list[Block] = []
    at, apart = 0, True

    def keep(end: int) -> None:
        nonlocal at, apart
        for block in blocks[at:end]:
            if block.glued and not apart and not block.cut and not out[-1].cut:
                last = out[-1]
                last.parts += block.parts
                last.linked += block.linked
                last.text, last.judged = " ".join("".join(last.parts).split()), False
            elif block.text or block.cut:
                out.append(block)
                apart = False
        at = max(at, end)

    for hint in hints:  # outer ones come first
        if hint.begin < at or hint.holds:
            continue
        own = letters[hint.end] - letters[hint.begin]
        if not hint.comments and 2 * own > letters[-1]:
            continue
        if hint.main or texts[hint.end] == texts[hint.begin]:
            keep(hint.begin)
            number, level = hint.region
            out.append(Block(region=number, level=level, cut=True, label=False))
            at, apart = hint.end, True
    keep(len(blocks))
    return out


def first_label(block: Block) -> bool | None:
    """Text, not text, or undecided."""
    letters = len(block.text) - block.text.count(" ")
    if block.linked >= LINKED * letters:
        return False
    words = _WORD.findall(block.text.lower())
    if len(words) >= LONG and sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * len(words):
        return True
    return None


def decide(blocks: list[Block]) -> list[str]:
    """The texts of the blocks that are text."""
    for block in blocks:
        if not block.cut and not block.judged:
            block.label = first_label(block)
    unsure = [b for b in blocks if b.label is None]
    # Cut parts tell where a page's own text ends; inside an article or main part they say nothing.
    decided = [None if b.cut and b.level else b.label for b in blocks]
    ahead: list[tuple[int, bool] | None] = [None] * len(blocks)
    near: dict[int, tuple[int, bool]] = {}
    for i in range(len(blocks) - 1, -1, -1):
        ahead[i] = near.get(blocks[i].region)
        if decided[i] is not None:
            near[blocks[i].region] = (i, decided[i])
    near.clear()
    for i, block in enumerate(blocks):
        if decided[i] is not None:
            near[block.region] = (i, decided[i])
        elif block.label is None:
            sides = [s for s in (near.get(block.region), ahead[i]) if s is not None]
            least = min((abs(at - i) for at, _ in sides), default=0)
            block.label = not sides or any(label for at, label in sides if abs(at - i) == least)
    kept = [b for b in blocks if b.label] or unsure
    level = max((b.level for b in kept), default=0)
    return [b.text for b in kept if b.level == level]


def main_text(page: str | None) -> str:
    return "\n".join(decide(Reader().read(page or "")))


def extracted(pages: DataFrame, markup: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with column ``out`` (replaced if there): each page's main text, blocks joined by newlines."""

    @F.arrow_udf("string")
    def extract(column: pa.Array) -> pa.Array:
        return pa.array([main_text(page) for page in column.to_pylist()], type=pa.string())

    return pages.withColumn(out, extract(F.col(markup)))
