"""Main text of web pages: flat text blocks and a decision tree.

A page is read once into a flat list of text blocks (runs of text between
block-level tags; markup, comments, scripts, styles and form controls leave no
text). A block is described by its word count and link density, those of the
block before and after it, and where it stands: in a container whose tag, class,
id or role names something other than the article, and in an article element (if
the page has one). A small decision tree, trained on the labelled table below,
says which blocks are content.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by one newline; nothing else is cut.

Defined results: NULL and empty pages have the empty text; unclosed and
stray tags are tolerated (an end tag closes what was opened inside it), at any depth of
nesting and any length of page; equal rows give equal texts, ties do not occur (blocks
keep their order); empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import read_table

# Fixed values of HTML: elements that end a text block, that have no end tag, and
# whose content is no text of the page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = "script|style|noscript|template|title|textarea|iframe"
# ... if they are closed; an end that is missing hides nothing.
CLOSED_SILENT_TAGS = "select|button|svg|object|audio|video|canvas"
# Elements that a following element of the same kind closes.
SELF_CLOSING = {"p": BLOCK_TAGS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
# Containers that are not the article, by tag and by words in class, id or role.
OTHER_TAGS = frozenset("nav aside footer menu dialog".split())
OTHER_WORDS = re.compile(
    r"(?<![a-z0-9])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|sidebar"
    r"|side|rail|menu|nav|navbar|navigation|topbar|breadcrumbs?|comments?|replies|reply|respond|disqus|shar(?:e|ing)|social|related"
    r"|recommend\w*|newsletter|subscribe|signup|widget|footer|header|masthead|copyright|legal|login|search|pagination|pager|tags"
    r"|contentinfo|complementary)(?![a-z0-9])"
)
# Names that say how a page is laid out or filed, not what the container is.
MODIFIERS = re.compile(r"(?<!\S)(?:(?:has|no|with|without|not|is|hide|show|tag|category)-\S+|\S+-(?:open|closed|enabled|disabled|visible|hidden))(?!\S)")
# Article elements that are not the article are named so by the first part of a name.
OTHER_ARTICLE = re.compile(r"(?<!\S)(?:comments?|repl(?:y|ies)|related|recommend\w*|teasers?|promo\w*|ad|ads|advert\w*|sponsor\w*)(?![a-z0-9])")
ARTICLE_WORDS = re.compile(r"(?<![a-z0-9])(?:article|main|post|entry|story|content)(?![a-z0-9])")

_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)"
    r"|<(?P<silent>" + SILENT_TAGS + r")\b(?>[^>\"']|\"[^\"]*\"|'[^']*')*+>(?s:.*?)(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<closed>" + CLOSED_SILENT_TAGS + r")\b(?>[^>\"']|\"[^\"]*\"|'[^']*')*+>(?s:.*?)</(?P=closed)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z!?][^>]*(?:>|\Z)",
    re.IGNORECASE,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    other: bool
    article: bool
    heading: bool
    named: int = 0


@dataclass
class _Open:
    tag: str
    other: bool
    article: bool
    named: int = 0  # the innermost container whose names say it is not the article, 0 for none


@dataclass
class _Named:
    """Such a container: the one around it, its unlinked words, and whether it has the page's title or article."""

    around: int
    words: int = 0
    main: bool = False


@dataclass
class _Reader:
    """Walks the tokens of one page."""

    blocks: list[Block] = field(default_factory=list)
    open: list[_Open] = field(default_factory=lambda: [_Open("", False, False)])
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: int = 0
    heading: bool = False
    named: list[_Named] = field(default_factory=lambda: [_Named(0)])
    depth: Counter = field(default_factory=Counter)  # open elements of each tag

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(html.unescape(raw).split())

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                top = self.open[-1]
                words = len(text.split(" "))
                self.blocks.append(Block(text, words, min(words, self.linked), top.other, top.article, self.heading, top.named))
            self.parts.clear()
        self.linked = 0

    def start(self, tag: str, attrs: str) -> None:
        if tag == "br" or tag == "wbr":
            self.parts.append(" " if tag == "br" else "")
            return
        if tag == "a":
            self.in_link += 1
            return
        if tag not in BLOCK_TAGS:
            return
        self.flush()
        if tag in VOID_TAGS:
            return
        top = self.open[-1]
        if tag in SELF_CLOSING.get(top.tag, ()):
            self.depth[self.open.pop().tag] -= 1
            top = self.open[-1]
        names = " ".join(x for m in _NAMES.findall(attrs) for x in m if x).lower() if attrs else ""
        names = MODIFIERS.sub(" ", names) if "-" in names else names
        named = names and tag in ("div", "section") and ARTICLE_WORDS.search(names)
        if tag in ("article", "main"):
            own = tag == "main" or ARTICLE_WORDS.search(names)
            hits = set() if own else set(OTHER_ARTICLE.findall(names))
        else:
            hits = set(OTHER_WORDS.findall(names)) if names and tag not in ("body", "html") else set()
        if named or top.article:
            hits.discard("header")  # the article's own
        if tag == "form":  # may be the page's frame, like any container by name
            hits.add(tag)
        article = tag in ("article", "main") or bool(named and not hits)
        other = tag in OTHER_TAGS or tag == "header" and not top.article
        if tag == "h1" or article and not hits:
            self.named[top.named].main = True
        if hits:
            self.named.append(_Named(top.named))
        self.open.append(_Open(tag, other or top.other, article or top.article, len(self.named) - 1 if hits else top.named))
        self.depth[tag] += 1
        self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
            return
        if tag not in BLOCK_TAGS:
            return
        self.flush()
        self.heading = False
        # Every element looked at is closed, so the stack is walked once however deep it is.
        while self.depth[tag]:
            closed = self.open.pop().tag
            self.depth[closed] -= 1
            if closed == tag:
                break


def _settle_names(found: list[Block], named: list[_Named]) -> None:
    """Blocks in containers named as other are other, but not by a container around
    most of the page's unlinked words that has its title or article, or all but
    what stands in other containers: that is the page's frame."""
    total = outside = 0
    for b in found:
        if not b.other:
            named[b.named].words += b.words - b.linked
            total += b.words - b.linked
            outside += 0 if b.named else b.words - b.linked
    for n in reversed(named[1:]):  # inner containers come after those around them
        around = named[n.around]
        around.words += n.words
        around.main |= n.main
    other = [False]
    for n in named[1:]:
        frame = 2 * n.words > total and (n.main or not outside)
        other.append(other[n.around] or not frame)
    for b in found:
        b.other = b.other or other[b.named]


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in order."""
    reader = _Reader()
    page = page or ""
    at = 0
    for m in _TOKEN.finditer(page):
        reader.text(page[at : m.start()])
        at = m.end()
        if m["tag"]:
            (reader.end if m["end"] else lambda t: reader.start(t, m["attrs"]))(m["tag"].lower())
    reader.text(page[at:])
    reader.flush()
    if len(reader.named) > 1:
        _settle_names(reader.blocks, reader.named)
    return reader.blocks


FEATURES = ["other", "article", "words", "links", "words_before", "links_before", "words_after", "links_after", "heading"]


def features(found: list[Block]) -> np.ndarray:
    """One row for each block; ``article`` is 0.5 on pages without such an element."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in found], dtype=float)
    links = np.array([b.linked / b.words for b in found])
    has = any(b.article and not b.other for b in found)
    return np.column_stack([
        [b.other for b in found], [float(b.article) if has else 0.5 for b in found], words, links,
        np.r_[0, words[:-1]], np.r_[0, links[:-1]], np.r_[words[1:], 0], np.r_[links[1:], 0], [b.heading for b in found],
    ])


# Blocks labelled by hand, in the order of FEATURES, then 1 for content.
LABELLED = [
    # pages with an article element: inside it
    (0, 1, 12, 0, 8, 0, 60, 0, 1, 1), (0, 1, 6, 0, 1, 1, 45, 0, 1, 1), (0, 1, 90, 0, 12, 0, 80, 0, 0, 1), (0, 1, 2, 0, 80, 0, 30, 0, 0, 1),
    (0, 1, 40, 0.1, 90, 0, 12, 0, 0, 1), (0, 1, 8, 0, 120, 0, 9, 0, 0, 1), (0, 1, 1, 0, 3, 0, 2, 0, 0, 1), (0, 1, 25, 0.5, 60, 0, 40, 0, 0, 1),
    (0, 1, 300, 0, 8, 0, 10, 0, 0, 1), (0, 1, 3, 1, 60, 0, 70, 0, 0, 1), (0, 1, 5, 0, 2, 0, 0, 0, 0, 1), (0, 1, 15, 0, 0, 0, 0, 0, 0, 1),
    # ... next to links: titles before a linked byline, bylines, linked list items, leads after a menu, last lines before a linked footer
    (0, 1, 7, 0, 1, 1, 3, 1, 1, 1), (0, 1, 4, 0, 0, 0, 2, 0.5, 1, 1), (0, 1, 3, 0.7, 7, 0, 60, 0, 0, 1), (0, 1, 2, 1, 5, 0, 20, 0, 0, 1),
    (0, 1, 4, 1, 3, 1, 5, 1, 0, 1), (0, 1, 9, 0.4, 6, 1, 8, 0.5, 0, 1), (0, 1, 1, 1, 1, 1, 1, 1, 0, 1), (0, 1, 12, 0, 4, 1, 6, 1, 0, 1),
    (0, 1, 14, 0, 1, 1, 70, 0, 0, 1), (0, 1, 24, 0, 2, 1, 55, 0, 0, 1), (0, 1, 6, 0, 1, 1, 0, 0, 0, 1), (0, 1, 20, 0, 3, 0.6, 8, 0, 0, 1),
    (0, 1, 10, 0, 60, 0, 1, 1, 0, 1), (0, 1, 5, 0, 45, 0, 4, 0.8, 0, 1), (0, 1, 16, 0, 30, 0, 2, 1, 0, 1), (0, 1, 3, 0, 12, 0, 3, 1, 0, 1),
    (0, 1, 40, 0, 1, 1, 2, 1, 0, 1), (0, 1, 2, 0, 2, 1, 2, 1, 0, 1), (0, 1, 30, 0.9, 50, 0, 40, 0.9, 0, 1), (0, 1, 8, 1, 20, 0, 0, 0, 0, 1),
    # ... and outside it
    (0, 0, 9, 0, 1, 1, 12, 0, 0, 0), (0, 0, 30, 0, 4, 1, 10, 0, 0, 0), (0, 0, 80, 0, 10, 0, 15, 0, 0, 0), (0, 0, 3, 1, 1, 1, 1, 1, 0, 0),
    (0, 0, 14, 0.2, 40, 0, 0, 0, 0, 0), (0, 0, 5, 0, 1, 1, 8, 0, 1, 0), (0, 0, 1, 1, 0, 0, 1, 1, 0, 0), (0, 0, 20, 0, 90, 0, 5, 0, 0, 0),
    # ... next to links: teasers and notes before a link list, titles of link lists, long texts before or after links
    (0, 0, 22, 0, 8, 0, 2, 1, 0, 0), (0, 0, 45, 0, 3, 1, 1, 1, 0, 0), (0, 0, 90, 0, 60, 0, 4, 0.8, 0, 0), (0, 0, 18, 0.1, 0, 0, 1, 1, 0, 0),
    (0, 0, 60, 0, 1, 1, 50, 0, 0, 0), (0, 0, 150, 0, 2, 1, 3, 1, 0, 0), (0, 0, 7, 0, 40, 0, 1, 1, 1, 0), (0, 0, 6, 0, 0, 0, 30, 0, 1, 0),
    (0, 0, 30, 0, 70, 0, 60, 0, 0, 0), (0, 0, 200, 0, 0, 0, 90, 0, 0, 0), (0, 0, 12, 0, 35, 0, 20, 0, 0, 0), (0, 0, 28, 0.5, 4, 1, 6, 1, 0, 0),
    # containers that are not the article, anywhere
    (1, 0, 1, 1, 1, 1, 1, 1, 0, 0), (1, 0, 10, 0, 1, 1, 12, 0, 0, 0), (1, 0, 45, 0, 60, 0, 30, 0, 0, 0), (1, 0, 120, 0, 90, 0, 10, 0, 0, 0),
    (1, 1, 12, 0, 80, 0, 60, 0, 0, 0), (1, 1, 35, 0.1, 60, 0, 50, 0, 0, 0), (1, 1, 4, 1, 70, 0, 40, 0, 0, 0), (1, 1, 80, 0, 50, 0, 30, 0, 0, 0),
    (1, 0.5, 2, 1, 2, 1, 2, 1, 0, 0), (1, 0.5, 18, 0, 4, 1, 90, 0, 0, 0), (1, 0.5, 60, 0, 120, 0, 40, 0, 0, 0), (1, 0.5, 6, 0, 0, 0, 50, 0, 1, 0),
    # pages without an article element: paragraphs, headings and short lines among them
    (0, 0.5, 60, 0, 40, 0, 50, 0, 0, 1), (0, 0.5, 120, 0.05, 8, 0, 70, 0, 0, 1), (0, 0.5, 25, 0, 50, 0, 45, 0, 0, 1), (0, 0.5, 18, 0.1, 35, 0, 60, 0, 0, 1),
    (0, 0.5, 8, 0, 70, 0, 55, 0, 0, 1), (0, 0.5, 4, 0, 60, 0, 40, 0, 0, 1), (0, 0.5, 7, 0, 2, 1, 60, 0, 1, 1), (0, 0.5, 9, 0, 0, 0, 45, 0, 1, 1),
    (0, 0.5, 30, 0, 6, 0, 12, 0, 0, 1), (0, 0.5, 45, 0.2, 3, 1, 20, 0, 0, 1), (0, 0.5, 22, 0, 50, 0, 3, 1, 0, 1), (0, 0.5, 5, 0, 40, 0, 5, 0, 0, 1),
    (0, 0.5, 8, 0.12, 50, 0, 1, 0, 0, 1), (0, 0.5, 10, 0, 60, 0, 5, 0, 0, 1), (0, 0.5, 12, 0, 45, 0, 0, 0, 0, 1), (0, 0.5, 7, 0, 42, 0, 2, 0, 0, 1),
    (0, 0.5, 2, 0, 1, 1, 1, 0, 1, 1), (0, 0.5, 3, 0, 1, 1, 6, 0, 1, 1), (0, 0.5, 5, 0, 0, 0, 2, 0, 1, 1), (0, 0.5, 4, 0, 30, 0, 8, 0, 1, 1),
    (0, 0.5, 1, 0, 2, 0, 40, 0, 0, 1), (0, 0.5, 2, 0, 38, 0, 25, 0, 0, 1), (0, 0.5, 14, 0, 5, 0, 9, 0, 0, 1), (0, 0.5, 11, 0.1, 16, 0, 14, 0, 0, 1),
    (0, 0.5, 9, 0, 22, 0, 30, 0, 0, 1), (0, 0.5, 13, 0, 2, 0, 16, 0, 0, 1), (0, 0.5, 20, 0, 2, 1, 1, 1, 0, 1), (0, 0.5, 6, 0, 28, 0, 26, 0, 0, 1),
    (0, 0.5, 6, 0, 0, 0, 22, 0, 1, 1), (0, 0.5, 200, 0, 0, 0, 0, 0, 0, 1), (0, 0.5, 16, 0.15, 20, 0, 18, 0, 0, 1), (0, 0.5, 35, 0, 1, 1, 1, 1, 0, 1),
    # ... menus, teasers, captions and small print around them
    (0, 0.5, 1, 1, 1, 1, 1, 1, 0, 0), (0, 0.5, 2, 1, 3, 1, 40, 0, 0, 0), (0, 0.5, 5, 0.8, 3, 1, 4, 1, 0, 0), (0, 0.5, 12, 0.9, 60, 0, 10, 0.9, 0, 0),
    (0, 0.5, 30, 0.7, 4, 1, 5, 1, 0, 0), (0, 0.5, 3, 0, 2, 1, 2, 1, 0, 0), (0, 0.5, 4, 0, 1, 1, 3, 0, 0, 0), (0, 0.5, 2, 0, 3, 0, 2, 0, 0, 0),
    (0, 0.5, 8, 0, 3, 1, 2, 1, 0, 0), (0, 0.5, 6, 0.5, 40, 0, 2, 1, 0, 0), (0, 0.5, 9, 0.6, 30, 0, 8, 0.5, 0, 0), (0, 0.5, 60, 0.95, 10, 1, 50, 0.9, 0, 0),
    (0, 0.5, 8, 0, 3, 1, 5, 1, 0, 0), (0, 0.5, 14, 0, 4, 1, 6, 1, 0, 0), (0, 0.5, 10, 0, 2, 1, 9, 0.9, 0, 0), (0, 0.5, 5, 0, 4, 0.9, 12, 0.8, 0, 0),
    (0, 0.5, 5, 0, 2, 1, 0, 0, 0, 0), (0, 0.5, 7, 0, 4, 1, 0, 0, 0, 0), (0, 0.5, 1, 0, 0, 0, 1, 1, 0, 0), (0, 0.5, 3, 1, 50, 0, 2, 1, 1, 0),
]


def train(table: list[tuple], depth: int = 8) -> tuple:
    """A binary classification tree (Gini impurity; of equal splits the first
    feature and smallest threshold): (feature, threshold, left, right) or a class."""
    data = np.array(table, dtype=float)

    def grow(rows: np.ndarray, left: int):
        y = rows[:, -1]
        if left == 0 or y.min() == y.max():
            return int(y.mean() >= 0.5)
        best = None
        for f in range(rows.shape[1] - 1):
            values = np.unique(rows[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                low = rows[:, f] <= cut
                gini = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
                if best is None or gini < best[0] - 1e-12:
                    best = (gini, f, cut, low)
        if best is None:
            return int(y.mean() >= 0.5)
        _, f, cut, low = best
        return f, float(cut), grow(rows[low], left - 1), grow(rows[~low], left - 1)

    return grow(data, depth)


def classify(tree, rows: np.ndarray) -> np.ndarray:
    """The class of every row."""
    out = np.zeros(len(rows), dtype=bool)

    def walk(node, at: np.ndarray) -> None:
        if not isinstance(node, tuple):
            out[at] = bool(node)
            return
        f, cut, low, high = node
        below = rows[at, f] <= cut
        walk(low, at[below])
        walk(high, at[~below])

    walk(tree, np.arange(len(rows)))
    return out


def main_text(page: str | None, tree) -> str:
    found = blocks(page)
    keep = classify(tree, features(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text", table: list[tuple] = LABELLED) -> DataFrame:
    """``pages`` plus the main text of ``html_col``; ``table``: the labelled blocks."""
    tree = train(table)

    @pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, tree) for p in batch], dtype=object)

    return pages.withColumn(out, texts(F.col(html_col)))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
