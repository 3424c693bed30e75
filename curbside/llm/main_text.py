"""Main text of HTML pages: flat text blocks, judged by a decision tree from shallow features.

A page becomes a flat list of text blocks. A block is known by its number of words and the share of them in links, by
the same of the blocks before and after it, and by what the containers around it say (an article, or a menu, a side
bar, comments ...). A decision tree, trained on the small labelled table in `page_examples`, tells main text from the
rest; the blocks it accepts are the page's text. Pages are independent of each other, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.page_examples import PAGES

# Elements of HTML by what they do to text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
UNSEEN = frozenset(  # what stands inside is no text of the page
    "script style noscript template textarea select button svg math iframe object audio video canvas title datalist "
    "noembed noframes applet".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {  # elements whose end tag may be left out, and what ends them
    "p": BLOCKS - {"body", "html"},
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option", "optgroup"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words of element, role, class and id names by what they announce.
MAIN_NAMES = frozenset("article main articlebody blogposting newsarticle post entry story content".split())
SIDE_NAMES = frozenset("sidebar side aside banner form rail".split())
HEAD_NAMES = frozenset("header masthead topbar top hero left right col column".split())
STRONG_NAMES = frozenset(
    "nav navigation navbar menu breadcrumb breadcrumbs footer contentinfo complementary search dialog alert alertdialog "
    "cookie cookies consent gdpr notice notices notification popup modal overlay comment comments disqus reply replies respond "
    "discussion ad ads adv advert adverts advertisement sponsor sponsored promo promotion newsletter subscribe signup "
    "login share sharing social related recommended trending widget pagination pager toc tags copyright disclaimer "
    "skip hidden responses feedback".split()
)
STRONG_STARTS = ("comment", "cookie", "advert", "newsletter", "breadcrumb", "disqus", "sponsor", "promo", "popup")  # also run together
STRONG_ELEMENTS = frozenset("nav footer aside menu dialog search".split())
SIDE_ELEMENTS = frozenset("form fieldset".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|itemtype)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.IGNORECASE)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

NOTHING, MAIN, HEAD, SIDE, STRONG = 0.0, 1.0, -0.9, -1.0, -2.0  # what a container says of the text in it
FEATURES = ("words", "links", "before_words", "before_links", "after_words", "after_links", "inside", "page_has_main", "heading")


@dataclass
class Block:
    """Text of a block with its words, those of them in links, and what surrounds it."""

    text: str
    words: int
    linked: int
    inside: float
    heading: bool


@dataclass
class _Element:
    name: str
    says: float
    heading: bool
    link: bool


def announced(name: str, attributes: str) -> float:
    """What an element says of the text in it, from its name, role, class and id."""
    says = (
        STRONG if name in STRONG_ELEMENTS else SIDE if name in SIDE_ELEMENTS else HEAD if name == "header"
        else MAIN if name in ("article", "main") else NOTHING
    )
    if not attributes:
        return says
    if _HIDDEN.search(attributes):
        return STRONG
    found: set[str] = set()
    for _, value in _NAMED.findall(attributes):
        for token in value.strip("\"'").split():
            found.update(p.lower() for p in _NAME_PART.findall(token))
            found.add(token.lower())
    if name in ("body", "html"):
        return says
    if name != "main" and (found & STRONG_NAMES or any(part.startswith(STRONG_STARTS) for part in found)):
        return STRONG
    if says == NOTHING and found & MAIN_NAMES and name in BLOCKS:
        return MAIN
    if says == NOTHING and found & SIDE_NAMES:
        return SIDE
    return HEAD if says == NOTHING and found & HEAD_NAMES else says


@dataclass
class _Flat:
    """The state of one walk over a page."""

    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    open: list[_Element] = field(default_factory=list)

    def inside(self) -> float:
        """The innermost statement counts, but nothing inside a menu, comment, footer ... is main text again. Inside an
        article a head or column belongs to it, a form or side bar does not; around an article they say nothing of it."""
        says = NOTHING
        for e in self.open:
            if says == STRONG:
                break
            if says == MAIN and e.says == SIDE:
                says = STRONG
            elif e.says and not (says == MAIN and e.says == HEAD):
                says = e.says
        return says

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            words = text.count(" ") + 1
            linked = min(words, len("".join(self.linked).split()))
            self.blocks.append(Block(text, words, linked, self.inside(), any(e.heading for e in self.open)))
        self.parts, self.linked = [], []

    def add(self, text: str) -> None:
        if text:
            self.parts.append(text)
            if any(e.link for e in self.open):
                self.linked.append(text + " ")

    def close(self, name: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].name == name:
                del self.open[at:]
                return

    def close_implied(self, name: str) -> None:
        """Ends elements that the start of `name` ends; inline elements left open end with their block."""
        for at in range(len(self.open) - 1, -1, -1):
            e = self.open[at].name
            if name in CLOSED_BY.get(e, ()):
                del self.open[at:]
            elif e in BLOCKS and e not in CLOSED_BY:
                return


def flat_blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, references decoded and white space made single spaces."""
    flat, at, page = _Flat(), 0, page or ""
    while at < len(page):
        tag = _TAG.search(page, at)
        flat.add(html.unescape(page[at : tag.start() if tag else len(page)]))
        if tag is None:
            break
        at, name = tag.end(), tag["name"]
        if tag["data"] is not None:
            flat.add(tag["data"])
        if name is None:
            continue
        name = name.lower()
        if tag["end"]:
            if name in BLOCKS:
                flat.flush()
            flat.close(name)
        elif name in UNSEEN:
            if not tag["rest"].endswith("/") or name not in ("svg", "math"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
        elif name == "br":
            flat.add(" ")
        else:
            if name in BLOCKS:
                flat.flush()
                flat.close_implied(name)
            if name not in VOID:
                flat.open.append(_Element(name, announced(name, tag["rest"]), name in HEADINGS, name == "a"))
    flat.flush()
    return flat.blocks


def features(blocks: Sequence[Block]) -> np.ndarray:
    """A row of FEATURES per block; beyond the ends of a page there are no words and no links."""
    words = np.array([0, *[b.words for b in blocks], 0], dtype=np.float64)
    links = np.array([0, *[b.linked for b in blocks], 0]) / np.maximum(words, 1)
    inside = np.array([b.inside for b in blocks], dtype=np.float64)
    return np.column_stack([
        words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:],
        inside, np.full(len(blocks), float((inside == MAIN).any())), [float(b.heading) for b in blocks],
    ]).reshape(len(blocks), len(FEATURES))


# -- the tree -----------------------------------------------------------------------------------

DEPTH, LEAST_LEAF = 6, 2


@dataclass(frozen=True)
class Tree:
    """A node asks whether feature <= cut, or, without branches, says how likely a block is main text."""

    share: float
    feature: int = -1
    cut: float = 0.0
    yes: Tree | None = None
    no: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.yes is None:
            return np.full(len(x), self.share > 0.5)
        below = x[:, self.feature] <= self.cut
        out = np.empty(len(x), dtype=bool)
        out[below], out[~below] = self.yes.predict(x[below]), self.no.predict(x[~below])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Tree:
    """The tree that greedily lowers the Gini impurity; of equal cuts the first feature's lowest."""
    n, share = len(y), float(y.mean())
    best = (share * (1 - share) * n - 1e-9, -1, 0.0)
    for f in range(x.shape[1]) if depth and 0 < share < 1 else ():
        order = np.argsort(x[:, f], kind="stable")
        v, hits = x[order, f], np.cumsum(y[order])
        k = np.arange(1, n)
        left, right = hits[:-1], hits[-1] - hits[:-1]
        impurity = left * (1 - left / k) + right * (1 - right / (n - k))
        allowed = (v[:-1] < v[1:]) & (k >= LEAST_LEAF) & (n - k >= LEAST_LEAF)
        if allowed.any():
            i = int(np.argmin(np.where(allowed, impurity, np.inf)))
            if impurity[i] < best[0]:
                best = (float(impurity[i]), f, float(v[i] + v[i + 1]) / 2)
    if best[1] < 0:
        return Tree(share)
    below = x[:, best[1]] <= best[2]
    return Tree(share, best[1], best[2], grow(x[below], y[below], depth - 1), grow(x[~below], y[~below], depth - 1))


def labelled_blocks(pages: Sequence[str] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features of the blocks of labelled pages, and their labels: each block's text starts with + or -."""
    found = [flat_blocks(page) for page in pages]
    labels = [float(b.text.startswith("+")) for blocks in found for b in blocks]
    return np.concatenate([features(blocks) for blocks in found]), np.array(labels)


def trained() -> Tree:
    return grow(*labelled_blocks())


# -- pages --------------------------------------------------------------------------------------


def main_text(page: str | None, tree: Tree) -> str:
    blocks = flat_blocks(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, is_main in zip(blocks, tree.predict(features(blocks))) if is_main)


def extracted(page: Column) -> Column:
    """Column of main texts of a column of pages; null pages give empty texts."""
    tree = trained()

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, tree) for p in batch], dtype=object)

    return of(page)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of `pages(page_id, url, html)`: page_id, url, text, n_chars (code points of the text).

    A null or empty page, and one without main text, gives the empty text. Null ids and repeated rows stay; other
    columns are ignored.
    """
    return pages.select("page_id", "url", extracted(F.col("html").cast("string")).alias("text")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
