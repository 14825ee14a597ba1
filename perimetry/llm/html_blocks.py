"""Main text of web pages: flat text blocks, classified by a decision tree.

Method. A page becomes a flat list of text blocks, cut at block-level tags. A block is described by its
word count and link density, those of the blocks before and after it, and by where it stands (inside an
article, inside a page part made for navigation or notices, heading). A decision tree decides which
blocks are main text; it is trained, by Gini impurity, on the small labelled table below. Where a page tells by its
tags or names which part is its article, the tree follows them; word counts and link density decide the rest, and
everything on pages that tell nothing.

Everything happens within one page, so pages are rows of a map and nothing is shuffled.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import as_bytes

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|textarea|iframe)(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)[^>]*>"
    r"|</?[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_BLANK = re.compile(r"\s+")
_HINT = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Fixed values of HTML: elements that end a line of text, and those whose content is never article text.
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre"
    " search section summary table tbody td tfoot th thead title tr ul".split()
)
# Never article text from their start tag to their own end tag; without that, or closed at once, they hold nothing.
_HIDDEN = frozenset("svg canvas audio video select template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_APART = frozenset("nav footer aside form head title button menu dialog search legend option".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OWN_CLOSERS = {"p": _BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
                "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
_APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist"
    " consent cookie cookies copyright disqus disclaimer feedback footer gdpr header login masthead menu menubar meta modal nav"
    " navbar navigation newsletter notice notices notification pager pagination paywall popup promo promoted promotion"
    " recommendations recommended related replies reply respond search share sharing sidebar sidenav signup skip social sponsor"
    " sponsored subscribe subscription tags teaser toc toolbar topbar widget widgets complementary contentinfo alert".split()
)
_WEAK_NAMES = frozenset("header meta banner widget toc teaser tags share social promo".split())  # also within main parts
# parts that hold articles of their own
_LIST_NAMES = frozenset(
    "comment comments commentlist disqus replies reply respond recommendations recommended related teaser".split()
)
_MAIN_NAMES = frozenset("article articlebody content entry main post story text body".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int  # words inside links
    heading: bool
    article: bool  # inside an article or the page's main part
    apart: bool  # inside a part made for navigation, notices, adverts, forms or comments; not if it wraps the article

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _names(attributes: str) -> set[str]:
    found: set[str] = set()
    for a, b, c in _HINT.findall(attributes):
        found.update(re.split(r"[^a-z0-9]+", (a or b or c).lower()))
    return found


def _tag(token: re.Match) -> tuple[str, bool]:
    """Name, empty for comments and raw text, and whether it is an end tag."""
    return (token[3] or token[6] or "").lower(), bool(token[2] or token[5])


class _Open(list):
    """Names of the open elements, outermost first. An end tag without a start tag costs nothing, and one with it
    looks only at elements that it closes, so any page takes time in proportion to its length."""

    def __init__(self) -> None:
        super().__init__()
        self.number: Counter[str] = Counter()

    def push(self, name: str) -> None:
        self.append(name)
        self.number[name] += 1

    def innermost(self, name: str) -> int | None:
        """Depth of the innermost open element of that name."""
        if not self.number[name]:
            return None
        depth = len(self) - 1
        while self[depth] != name:
            depth -= 1
        return depth

    def cut(self, depth: int) -> None:
        """Close the elements from that depth on."""
        while len(self) > depth:
            self.number[self.pop()] -= 1


def _hidden(tokens: list[re.Match]) -> dict[int, int]:
    """Start tags of ``_HIDDEN`` elements that have an end tag of their own, with its place. An element that is
    still open where the one around it ends has none."""
    found: dict[int, int] = {}
    open_, places = _Open(), []
    if not any(_tag(t)[0] in _HIDDEN for t in tokens):
        return found
    for place, token in enumerate(tokens):
        name, closing = _tag(token)
        if name not in _HIDDEN and name not in _BLOCK or name in _VOID:
            continue
        if closing:
            depth = open_.innermost(name)
            if depth is not None:
                if name in _HIDDEN:
                    found[places[depth]] = place
                open_.cut(depth)
                del places[depth:]
        elif name != "svg" or not (token[4] or "").endswith("/"):
            open_.push(name)
            places.append(place)
    return found


def _marks(name: str, attributes: str) -> tuple[bool, set[str]]:
    """Whether an element is an article or the main part, and its names that speak against it."""
    names = _names(attributes) if "=" in attributes and name not in ("body", "html") else set()
    main = name in ("article", "main") or bool(names & _MAIN_NAMES)
    return main, names & _APART_NAMES - (_WEAK_NAMES if main else frozenset())


@dataclass
class _Part:
    """An element with a mark against it, and what is known of the main parts in it."""

    start: int
    outer: _Part | None
    fixed: bool  # by its element; only names, forms and searches can be wrappers
    form: bool
    lists: bool
    before: int  # characters of text
    end: int = 0
    size: int = 0
    main: bool = False  # holds a <main>
    article: bool = False  # an <article>
    named: bool = False  # an element named like a main part
    first: float = math.inf  # of the main parts in it: where the first one ends and the last one starts
    last: float = -math.inf

    def take(self, inner: _Part) -> None:
        self.main |= inner.main
        self.article |= inner.article
        self.named |= inner.named
        self.first, self.last = min(self.first, inner.first), max(self.last, inner.last)


def _wrappers(page: str, tokens: list[re.Match], hidden: dict[int, int]) -> set[int]:
    """Start tags whose mark does not count, as they hold the page's article: a form around the page, or
    a class like ``has-sidebar`` on its outer element.

    Such an element holds the <main>; or an <article>, and no main part stands elsewhere, or it holds half of
    the page's text; or half of the text and a part named like a main one (a form needs none). An article in
    a list of its own kind, as of comments, counts only if the page has no other main part. Larger elements
    are judged first; what a wrapper holds then belongs to the marked part around it, or to the page.
    """
    found: list[_Part] = []
    free = _Part(-1, None, True, False, False, 0)  # the page outside marked parts
    open_ = _Open()
    held: list[tuple[_Part, int | None]] = []  # innermost marked part; place if it is a main part
    chars = at = resume = 0

    def close(depth: int, place: int) -> None:
        for level in range(len(open_) - 1, depth - 1, -1):
            part, article = held[level]
            if part is not (held[level - 1][0] if level else free):
                part.end, part.size = place, chars - part.before
            if article is not None:
                part.first, part.last = min(part.first, place), max(part.last, article)
        open_.cut(depth)
        del held[depth:]

    for place, token in enumerate(tokens):
        if place < resume:
            continue
        chars += len(page[at : token.start()].strip())
        at = token.end()
        if place in hidden:
            resume = hidden[place] + 1
            at = tokens[hidden[place]].end()
            continue
        name, closing = _tag(token)
        if name not in _BLOCK or name in _VOID:
            continue
        if closing:
            depth = open_.innermost(name)
            if depth is not None:
                close(depth, place)
            continue
        while open_ and name in _OWN_CLOSERS.get(open_[-1], ()):
            close(len(open_) - 1, place)
        main, against = _marks(name, token[4] or "")
        outer, article = held[-1][0] if held else free, None
        if against or name in _APART:
            form = name in ("form", "search")
            found.append(_Part(place, outer, name in _APART and not form, name == "form", bool(against & _LIST_NAMES), chars))
            outer = found[-1]
        elif main:
            outer.main |= name == "main"
            outer.article |= name == "article"
            outer.named = True
            article = place
        open_.push(name)
        held.append((outer, article))
    chars += len(page[at:].strip())
    close(0, len(tokens))
    out: set[int] = set()
    parts = {part.start: part for part in found}
    waiting = [(-part.size, part.start) for part in found if not part.fixed]
    heapq.heapify(waiting)
    while waiting:
        part = parts[heapq.heappop(waiting)[1]]
        half = 2 * part.size >= chars
        elsewhere = free.first < part.start or free.last > part.end or (part.lists and free.named)
        if part.start in out or not (
            part.main or (part.article and (not elsewhere or (half and not part.lists)))
            or (half and not part.lists and (part.named or part.form))
        ):
            continue
        out.add(part.start)
        outer, passed = part.outer, [part]
        while outer.start in out:
            passed.append(outer)
            outer = outer.outer
        for inner in passed:
            inner.outer = outer
        outer.take(part)
        if not outer.fixed:
            heapq.heappush(waiting, (-outer.size, outer.start))
    return out


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; character references decoded, white space turned into one blank."""
    out: list[Block] = []
    open_ = _Open()  # block-level elements
    marks: list[tuple[bool, bool]] = []  # article, apart of each
    parts: list[str] = []
    linked: list[str] = []
    links, heading = 0, False

    def end() -> None:
        nonlocal heading
        text = _BLANK.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            in_links = html.unescape(" ".join(linked)).split()
            article, apart = marks[-1] if marks else (False, False)
            out.append(Block(text, len(text.split()), min(len(in_links), len(text.split())), heading, article, apart))
        parts.clear()
        linked.clear()

    def enter(name: str, attributes: str, wraps: bool) -> None:
        article, apart = marks[-1] if marks else (False, False)
        main, against = _marks(name, attributes)
        if not wraps and (name in _APART or (name == "header" and not article) or against):
            apart = True
        open_.push(name)
        marks.append((article or main, apart))

    def leave(depth: int | None) -> None:
        if depth is not None:
            open_.cut(depth)
            del marks[depth:]

    at, resume = 0, 0
    tokens = list(_TOKEN.finditer(page))
    hidden = _hidden(tokens)
    wrappers = _wrappers(page, tokens, hidden)
    for place, token in enumerate(tokens):
        if place < resume:
            continue
        if token.start() > at:
            piece = page[at : token.start()]
            parts.append(piece)
            if links:
                linked.append(piece)
        at = token.end()
        if place in hidden:
            resume = hidden[place] + 1
            at = tokens[hidden[place]].end()
            continue
        name, closing = _tag(token)
        if not name:
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            parts.append(" ")
        elif name in _BLOCK:
            end()
            if closing:
                leave(open_.innermost(name))
                heading = heading and name not in _HEADINGS
            else:
                while open_ and name in _OWN_CLOSERS.get(open_[-1], ()):
                    leave(len(open_) - 1)
                heading = name in _HEADINGS
                links = 0
                if name not in _VOID:
                    enter(name, token[4] or "", place in wrappers)
    if at < len(page):
        parts.append(page[at:])
    end()
    return out


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "heading", "article", "apart")


def features(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; beyond the page's ends there are no words."""
    own = np.array([(b.words, b.density, b.heading, b.article, b.apart) for b in found], dtype=np.float64).reshape(-1, 5)
    edge = np.zeros((1, 2))
    before, after = np.r_[edge, own[:-1, :2]], np.r_[own[1:, :2], edge]
    return np.c_[own[:, :2], before[: len(own)], after[: len(own)], own[:, 2:]]


# The labelled table: FEATURES, then 1 for main text. Blocks of typical pages, marked by hand.
LABELLED = (
    # inside an article: headings, paragraphs of any length, neighbours of any kind
    (9, 0, 14, 0, 60, 0, 1, 1, 0, 1), (4, 0, 1, 1, 45, 0, 1, 1, 0, 1), (60, 0, 9, 0, 35, 0, 0, 1, 0, 1),
    (1, 0, 40, 0, 2, 0, 0, 1, 0, 1), (2, 0, 1, 0, 80, 0, 0, 1, 0, 1), (250, 0.02, 60, 0, 12, 0.9, 0, 1, 0, 1),
    (35, 0.1, 250, 0, 0, 0, 0, 1, 0, 1), (6, 0, 1, 0, 4, 0, 0, 1, 0, 1), (18, 0.3, 40, 0, 22, 0.1, 0, 1, 0, 1),
    (12, 0, 35, 0, 8, 0.1, 0, 1, 0, 1), (1, 0, 1, 0, 1, 0, 0, 1, 0, 1), (3, 0, 0, 0, 0, 0, 0, 1, 0, 1),
    (9, 0.4, 70, 0, 60, 0, 0, 1, 0, 1), (5, 0, 90, 0, 9, 0, 1, 1, 0, 1), (40, 0.45, 3, 0, 50, 0, 0, 1, 0, 1),
    (1, 1, 1, 1, 60, 0, 0, 1, 0, 0), (2, 1, 3, 1, 2, 1, 0, 1, 0, 0), (4, 1, 60, 0, 3, 1, 0, 1, 0, 0),
    (8, 1, 3, 1, 9, 1, 0, 1, 0, 0), (3, 1, 40, 0, 0, 0, 0, 1, 0, 0),
    # inside parts made for something else, within an article or not
    (1, 1, 1, 1, 1, 1, 0, 0, 1, 0), (2, 1, 12, 0, 1, 1, 0, 0, 1, 0), (9, 0, 1, 1, 9, 0, 0, 0, 1, 0),
    (14, 0, 1, 1, 60, 0, 0, 0, 1, 0), (60, 0, 9, 0, 35, 0, 0, 0, 1, 0), (120, 0.01, 60, 0, 40, 0, 0, 0, 1, 0),
    (30, 0, 200, 0, 25, 0, 0, 1, 1, 0), (8, 0, 90, 0, 60, 0, 0, 1, 1, 0), (90, 0, 250, 0, 3, 0, 0, 1, 1, 0),
    (3, 0, 25, 0, 90, 0, 1, 1, 1, 0), (2, 0, 1, 0, 60, 0, 1, 0, 1, 0), (11, 0.1, 120, 0, 0, 0, 0, 0, 1, 0),
    (5, 0.6, 40, 0, 4, 0.5, 0, 0, 1, 0), (45, 0, 2, 0, 50, 0, 0, 1, 1, 0), (1, 0, 5, 0, 1, 1, 0, 0, 1, 0),
    # pages without an article: runs of text against short and linked blocks
    (70, 0, 8, 0, 55, 0, 0, 0, 0, 1), (55, 0.05, 70, 0, 90, 0, 0, 0, 0, 1), (25, 0, 60, 0, 40, 0, 0, 0, 0, 1),
    (12, 0, 70, 0, 45, 0, 0, 0, 0, 1), (7, 0, 50, 0, 60, 0, 1, 0, 0, 1), (8, 0, 3, 1, 70, 0, 1, 0, 0, 1),
    (40, 0.1, 12, 0, 4, 1, 0, 0, 0, 1), (30, 0, 2, 1, 20, 0, 0, 0, 0, 1), (3, 0, 45, 0, 38, 0, 0, 0, 0, 1),
    (2, 1, 3, 1, 2, 1, 0, 0, 0, 0), (1, 1, 1, 1, 70, 0, 0, 0, 0, 0), (4, 0, 2, 1, 3, 1, 0, 0, 0, 0),
    (6, 0, 1, 1, 2, 1, 0, 0, 0, 0), (9, 0.5, 4, 0.8, 3, 1, 0, 0, 0, 0), (5, 0, 0, 0, 1, 1, 0, 0, 0, 0),
    (4, 0, 60, 0, 0, 0, 0, 0, 0, 0), (7, 0.2, 3, 1, 0, 0, 0, 0, 0, 0), (3, 0, 1, 1, 4, 1, 1, 0, 0, 0),
    (14, 0.9, 60, 0, 12, 0.9, 0, 0, 0, 0), (20, 0.8, 18, 0.9, 15, 0.7, 0, 0, 0, 0), (2, 0, 3, 0, 2, 0, 0, 0, 0, 0),
)


@dataclass(frozen=True)
class Tree:
    """A node; a leaf has no ``feature``."""

    main: bool
    feature: int | None = None
    most: float = 0.0  # rows with at most this go to the first branch
    branches: tuple[Tree, Tree] | None = None

    def decide(self, rows: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(rows), self.main)
        low = rows[:, self.feature] <= self.most
        out = np.empty(len(rows), bool)
        out[low], out[~low] = self.branches[0].decide(rows[low]), self.branches[1].decide(rows[~low])
        return out


def grow(rows: np.ndarray, main: np.ndarray, depth: int = 6, least: int = 1) -> Tree:
    """Split by the feature and threshold with the smallest Gini impurity, first ones on ties."""
    leaf = Tree(bool(2 * main.sum() >= len(main)) if len(main) else False)
    if depth == 0 or len(main) < 2 * least or main.all() or not main.any():
        return leaf
    best = None
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        values, hits = rows[order, feature], np.cumsum(main[order])
        n = np.arange(1, len(values))
        cut = np.flatnonzero((values[1:] > values[:-1]) & (n >= least) & (len(values) - n >= least))
        if not len(cut):
            continue
        left, rest = cut + 1, len(values) - cut - 1
        p, q = hits[cut] / left, (hits[-1] - hits[cut]) / rest
        impurity = left * p * (1 - p) + rest * q * (1 - q)
        at = int(impurity.argmin())
        if best is None or impurity[at] < best[0] - 1e-12:
            best = (impurity[at], feature, (values[cut[at]] + values[cut[at] + 1]) / 2)
    if best is None:
        return leaf
    low = rows[:, best[1]] <= best[2]
    return Tree(leaf.main, best[1], float(best[2]),
                (grow(rows[low], main[low], depth - 1, least), grow(rows[~low], main[~low], depth - 1, least)))


@cache
def trained() -> Tree:
    table = np.array(LABELLED, dtype=np.float64)
    return grow(table[:, :-1], table[:, -1] == 1)


def main_text(page: str, tree: Tree) -> str:
    """The page's main blocks, joined by line breaks."""
    found = blocks(page)
    kept = tree.decide(features(found)) if found else []
    return "\n".join(b.text for b, main in zip(found, kept) if main)


def extract(
    pages: DataFrame, tree: Tree | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null and empty pages and pages without main text have an empty text. Unclosed comments and
    raw text (scripts, styles, text areas, frames) run to the end of the page; an unclosed video, select or
    the like holds nothing; a cut-off tag at the end is dropped. Long pages are read whole, in time proportional to
    their length, one page at a time. Repeated rows give repeated
    rows, an empty table an empty result; other columns are not read.
    """
    tree = tree or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text((h.as_py() or b"").decode("utf-8", "replace"), tree) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col), F.col(url_col).cast("string"), as_bytes(html_col)).mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
