"""Main text of HTML pages: flat text blocks with the word counts and link densities of neighbours, and a decision tree.

One pass over the tags cuts a page into flat blocks. Each block has its number of words and its share of words in links,
those of the blocks before and after it, whether it lies in an article and whether it is a heading. Names (tags, classes,
ids, roles) only tell where a part of a page begins and ends; what counts is how many of the page's words outside links
that part holds (``part_share``), so a wrapper that is called sidebar, form or notice doesn't take the text with it. A
decision tree, grown once per process on the small labelled table below, tells main text from the rest.

Defined results: null or empty html has empty text; scripts, styles, comments and other invisible elements are never text;
pages that end early, wrong nesting, unclosed tags and unclosed quotes are read as far as they go; texts of any length are
kept whole; rows are read one by one, so repeated rows have equal texts; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is no text; void elements; and elements that end a block.
SKIPPED = frozenset("script style noscript template svg math title textarea select option iframe object canvas audio video button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Block elements whose extent matters: they may hold blocks.
CONTAINERS = BLOCKS - frozenset("p h1 h2 h3 h4 h5 h6 hr html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What parts of a page are called by tag, role, and the words of class and id.
NAMED_TAGS = frozenset("nav footer aside form dialog menu search".split())
NAMED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert".split())
NAMED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promos cookie cookies consent gdpr privacy notice notices "
    "notification alert nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead footer foot sidebar sidebars rail aside widget widgets comment comments "
    "commentlist disqus discussion reply replies respond share sharing social related recommended recommendations newsletter subscribe subscription "
    "signup login search popup modal overlay toolbar pagination pager copyright legal disclaimer skip skiplink trending popular".split()
)
#: The same, unless the part lies in an article: an article's own header belongs to it.
OUTER_WORDS = frozenset("header head topbar banner".split())
#: A class that begins so tells what stands beside a part, or how it looks, not what it is.
MODIFIERS = frozenset("has with no not without is show hide hidden under over beside".split())
#: Parts of readers: an article element inside them is a comment, not the article.
READERS = frozenset("comment comments commentlist disqus discussion reply replies".split())
ARTICLE_TAGS = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article main content post entry story hentry".split())

#: A quote opens a value only behind an equals sign; one that is never closed is a character like any other.
_NEXT = re.compile(r"""<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(>|$))""")
_NAMED = re.compile(r"""\b(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ROLE = re.compile(r"""\brole\s*=\s*["']?([a-z]+)""", re.I)


@dataclass
class Block:
    """A text block; ``part`` and ``article`` number the named part and the article it lies in, 0 for none."""

    text: str
    words: int
    linked: int
    part: int
    article: int
    heading: bool


def _names(attributes: str) -> set[str]:
    """The words of the class and id tokens that name something."""
    found: set[str] = set()
    for groups in _NAMED.findall(attributes):
        for token in "".join(groups).split():
            words = [w.lower() for w in _WORD.findall(token)]
            if words and words[0] not in MODIFIERS:
                found.update(words)
    return found


class _Parts:
    """Numbers the named parts and articles of a page."""

    def __init__(self) -> None:
        self.count = 0
        self.readers: set[int] = set()

    def inside(self, name: str, attributes: str, part: int, article: int) -> tuple[int, int]:
        """The part and the article that hold what stands inside an element of (part, article)."""
        names = _names(attributes) if attributes else set()
        role = _ROLE.search(attributes) if attributes else None
        own_article = name in ARTICLE_TAGS or bool(role and role[1].lower() in ARTICLE_TAGS) or not names.isdisjoint(ARTICLE_WORDS)
        by_readers = not names.isdisjoint(READERS)
        if own_article and not by_readers and part not in self.readers and (not part or name in ARTICLE_TAGS):
            self.count += not article
            return 0, article or self.count
        is_named = name in NAMED_TAGS or by_readers or not names.isdisjoint(NAMED_WORDS) or bool(role and role[1].lower() in NAMED_ROLES)
        if is_named or not article and (name == "header" or not names.isdisjoint(OUTER_WORDS)):
            self.count += 1
            if by_readers or part in self.readers:
                self.readers.add(self.count)
            part = self.count
        return part, article


def blocks(page: str) -> list[Block]:
    """The flat blocks of a page in page order, without empty ones."""
    found: list[Block] = []
    parts = _Parts()
    open_parts: list[tuple[str, int, int]] = []
    pieces: list[str] = []
    spans: list[tuple[bool, str]] = []
    part = article = 0
    heading = link = False
    at, end = 0, len(page)

    def close() -> None:
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            linked = sum(len(entities.unescape(s).split()) for inside, s in spans if inside)
            found.append(Block(text, len(text.split()), linked, part, article, heading))
        pieces.clear()
        spans.clear()

    def add(text: str) -> None:
        if text:
            pieces.append(text)
            spans.append((link, text))

    while at < end:
        m = _NEXT.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[1]:
            stop = page.find("-->", m.end() - 2)
            at = end if stop < 0 else stop + 3
            continue
        if m[2]:
            stop = page.find(">", at)
            at = end if stop < 0 else stop + 1
            continue
        closing, name, attributes = m[3], m[4].lower(), m[5]
        if name in SKIPPED:
            if not closing and not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "a":
            link = not closing
        elif name == "br":
            add(" ")
        elif name in BLOCKS:
            close()
            link = False
            heading = name in HEADINGS and not closing
            if name in CONTAINERS and not closing and not attributes.endswith("/"):
                open_parts.append((name, part, article))
                part, article = parts.inside(name, attributes, part, article)
            elif name in CONTAINERS and closing:
                for k in range(len(open_parts) - 1, -1, -1):
                    if open_parts[k][0] == name:
                        _, part, article = open_parts[k]
                        del open_parts[k:]
                        break
    close()
    return found


#: What the tree sees of a block.
FEATURES = ["words", "link_density", "words_before", "density_before", "words_after", "density_after", "part_share", "article", "heading"]
#: The labelled table: FEATURES, then 1 for main text and 0 for the rest.
LABELLED = [
    # menus, breadcrumbs and lists of links
    (1, 1.0, 0, 0.0, 1, 1.0, 0.0, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0.0, 0, 0, 0), (2, 1.0, 1, 1.0, 14, 0.0, 0.0, 0, 0, 0), (3, 1.0, 2, 1.0, 2, 1.0, 1.0, 0, 0, 0),
    (1, 1.0, 3, 1.0, 1, 1.0, 1.0, 0, 0, 0), (2, 1.0, 0, 0.0, 2, 1.0, 1.0, 0, 0, 0), (12, 0.9, 2, 1.0, 6, 1.0, 1.0, 0, 0, 0), (8, 0.75, 30, 0.1, 8, 0.8, 1.0, 0, 0, 0),
    (25, 0.8, 4, 1.0, 20, 0.9, 1.0, 0, 0, 0), (6, 0.5, 5, 0.6, 7, 0.5, 1.0, 0, 0, 0), (40, 0.6, 30, 0.7, 3, 1.0, 1.0, 0, 0, 0),
    (4, 0.9, 60, 0.0, 5, 0.8, 1.0, 0, 0, 0), (1, 1.0, 80, 0.0, 1, 1.0, 1.0, 0, 0, 0), (1, 1.0, 1, 1.0, 80, 0.0, 1.0, 0, 0, 0), (10, 0.7, 12, 0.8, 70, 0.0, 1.0, 0, 0, 0),
    (3, 0.5, 4, 0.5, 2, 0.5, 1.0, 0, 0, 0), (15, 0.9, 90, 0.0, 0, 0.0, 1.0, 0, 0, 0), (6, 1.0, 0, 0.0, 60, 0.0, 1.0, 0, 0, 0), (2, 1.0, 40, 0.0, 0, 0.0, 1.0, 0, 0, 0),
    # adverts, notices and forms
    (12, 0.0, 1, 1.0, 10, 0.0, 0.0, 0, 0, 0), (45, 0.0, 2, 1.0, 60, 0.0, 0.2, 0, 0, 0), (20, 0.1, 0, 0.0, 8, 0.0, 0.05, 0, 0, 0), (5, 0.0, 60, 0.0, 45, 0.0, 0.0, 1, 0, 0),
    (30, 0.0, 50, 0.0, 70, 0.0, 0.1, 1, 0, 0), (3, 0.0, 12, 0.0, 1, 0.0, 0.03, 0, 1, 0), (4, 0.0, 2, 0.5, 2, 0.0, 0.02, 0, 0, 0), (18, 0.0, 4, 0.0, 20, 0.0, 0.3, 0, 0, 0),
    # readers' comments and sidebars
    (60, 0.0, 4, 0.5, 40, 0.0, 0.4, 0, 0, 0), (90, 0.0, 100, 0.0, 3, 0.6, 0.45, 1, 0, 0), (15, 0.0, 3, 0.3, 25, 0.0, 0.1, 1, 0, 0), (22, 0.2, 8, 1.0, 10, 0.5, 0.15, 0, 0, 0), (2, 0.0, 80, 0.0, 30, 0.0, 0.2, 0, 1, 0),
    # footers
    (14, 0.0, 70, 0.0, 0, 0.0, 0.05, 0, 0, 0), (6, 0.3, 40, 0.0, 4, 1.0, 0.01, 0, 0, 0), (5, 0.0, 4, 1.0, 0, 0.0, 1.0, 0, 0, 0), (7, 0.1, 3, 1.0, 2, 1.0, 1.0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 1.0, 0, 1, 0),
    (8, 0.0, 2, 1.0, 0, 0.0, 1.0, 0, 0, 0), (3, 0.0, 1, 1.0, 0, 0.0, 1.0, 0, 0, 0), (2, 0.0, 5, 0.6, 3, 1.0, 1.0, 0, 0, 0),
    # paragraphs, headings, short lines and lists of an article
    (80, 0.0, 10, 0.0, 60, 0.0, 1.0, 1, 0, 1), (1, 0.0, 60, 0.0, 40, 0.0, 1.0, 1, 0, 1), (1, 0.0, 1, 0.0, 1, 0.0, 1.0, 1, 0, 1), (10, 0.0, 14, 0.0, 80, 0.0, 1.0, 1, 1, 1),
    (8, 0.0, 3, 1.0, 1, 0.0, 1.0, 1, 1, 1), (35, 0.3, 70, 0.0, 20, 0.1, 1.0, 1, 0, 1), (6, 1.0, 50, 0.0, 60, 0.0, 1.0, 1, 0, 1), (3, 1.0, 4, 1.0, 2, 1.0, 1.0, 1, 0, 1),
    (2, 0.0, 90, 0.0, 0, 0.0, 1.0, 1, 0, 1), (200, 0.02, 0, 0.0, 150, 0.0, 1.0, 1, 0, 1), (5, 0.6, 5, 0.6, 5, 0.6, 1.0, 1, 0, 1), (4, 0.0, 0, 0.0, 0, 0.0, 1.0, 1, 0, 1),
    (2, 0.0, 2, 1.0, 60, 0.0, 1.0, 1, 1, 1), (1, 0.0, 1, 1.0, 80, 0.0, 1.0, 1, 1, 1), (3, 0.0, 4, 1.0, 12, 0.0, 1.0, 1, 0, 1), (5, 0.0, 3, 1.0, 0, 0.0, 1.0, 1, 0, 1),
    # the same on pages that name no article
    (3, 0.0, 2, 1.0, 70, 0.0, 1.0, 0, 1, 1), (6, 0.0, 1, 1.0, 40, 0.0, 1.0, 0, 1, 1),
    (60, 0.0, 8, 0.0, 50, 0.0, 1.0, 0, 0, 1), (45, 0.1, 50, 0.0, 3, 1.0, 1.0, 0, 0, 1), (120, 0.0, 1, 1.0, 80, 0.05, 1.0, 0, 0, 1), (18, 0.0, 40, 0.0, 25, 0.0, 1.0, 0, 0, 1),
    (9, 0.0, 12, 0.0, 70, 0.0, 1.0, 0, 1, 1), (30, 0.2, 3, 1.0, 5, 1.0, 1.0, 0, 0, 1), (5, 0.0, 60, 0.0, 55, 0.0, 1.0, 0, 0, 1), (14, 0.0, 35, 0.0, 16, 0.0, 1.0, 0, 0, 1), (22, 0.0, 0, 0.0, 0, 0.0, 1.0, 0, 0, 1),
    # the same in wrappers with the name of something else that hold most of the page
    (80, 0.0, 6, 0.0, 80, 0.0, 0.9, 0, 0, 1), (60, 0.05, 80, 0.0, 4, 0.5, 0.75, 0, 0, 1), (7, 0.0, 3, 1.0, 90, 0.0, 0.85, 0, 1, 1), (25, 0.0, 60, 0.0, 40, 0.0, 0.95, 0, 0, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 0.9, 0, 0, 0), (4, 1.0, 70, 0.0, 3, 1.0, 0.8, 0, 0, 0),
]


@dataclass(frozen=True)
class Tree:
    """A node that sends rows up to ``threshold`` of ``feature`` to ``low``, or a leaf with a verdict."""

    verdict: bool = False
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.verdict)
        is_low = rows[:, self.feature] <= self.threshold
        out = np.empty(len(rows), bool)
        out[is_low], out[~is_low] = self.low.predict(rows[is_low]), self.high.predict(rows[~is_low])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> Tree:
    """A tree of binary splits by Gini impurity, until the labels of a node agree."""
    share = labels.mean()
    best = (0.0, -1, 0.0)
    if depth and 0 < share < 1:
        whole = share * (1 - share) * len(labels)
        for j in range(rows.shape[1]):
            values = np.unique(rows[:, j])
            for threshold in (values[1:] + values[:-1]) / 2:
                low = rows[:, j] <= threshold
                a, b = labels[low], labels[~low]
                gain = whole - a.mean() * (1 - a.mean()) * len(a) - b.mean() * (1 - b.mean()) * len(b)
                if gain > best[0] + 1e-9:
                    best = (gain, j, float(threshold))
    if best[1] < 0:
        return Tree(verdict=bool(share > 0.5))
    low = rows[:, best[1]] <= best[2]
    return Tree(feature=best[1], threshold=best[2], low=grow(rows[low], labels[low], depth - 1), high=grow(rows[~low], labels[~low], depth - 1))


@lru_cache(1)
def tree() -> Tree:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def part_shares(found: list[Block]) -> np.ndarray:
    """For each block the share of the page's words outside links that its named part holds; 1 outside of named parts.

    Where an article has words of its own, the other parts have no share in the main text: 0.
    """
    plain = np.array([b.words - b.linked for b in found], float)
    part = np.array([b.part for b in found], np.int64)
    rival = any(b.article and not b.part and b.words > b.linked for b in found)
    held = np.bincount(part, plain) / max(1.0, plain.sum())
    return np.where(part == 0, 1.0, 0.0 if rival else held[part])


def features(found: list[Block]) -> np.ndarray:
    own = np.array([(b.words, b.linked / b.words if b.words else 0.0) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    flags = np.array([(bool(b.article), b.heading) for b in found], float).reshape(-1, 2)
    return np.hstack([own, np.vstack([edge, own])[:-1], np.vstack([own, edge])[1:], part_shares(found)[:, None], flags])


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks in page order, parted by empty lines."""
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, good in zip(found, tree().predict(features(found)), strict=True) if good)


def main_text_column(page: Column) -> Column:
    """``main_text`` of each page."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], index=pages.index, dtype=object)

    return extracted(page)
